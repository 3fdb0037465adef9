"""Schemas of clip records and of the tables beside them."""

METRICS = "struct<saturation:double,vmaf:double,unimatch:double,dover_tech:double,dover_aes:double,scene_cuts:int,vlm_entity_density:int,vlm_quality:double,vlm_reject_flags:array<string>,vlm_scene_type:string,vlm_scene_transition:struct<label:string,count:int,timestamps_sec:array<double>,evidence:string>>"
CAMERA = "struct<fov_x:double,fov_y:double,focal_div:double,scale_cov:double,fov_x_min:double,fov_x_max:double,fov_y_min:double,fov_y_max:double,focal_div_max:double>"
CLIP_FIELDS = {
    "clip_id": "string", "source": "string", "video_path": "string", "mode": "string", "fps": "double", "num_frames": "int", "width": "int", "height": "int",
    "pose_path": "string", "intrinsics_path": "string", "scale_factors": "array<double>", "pose_mode": "string", "pose_units": "string",
    "metrics": METRICS, "camera": CAMERA, "kept": "boolean", "kept_tier": "string", "reject_reasons": "array<string>", "caption": "string",
}
CLIP = ", ".join(f"{k} {v}" for k, v in CLIP_FIELDS.items())
OWNER = "clip_id string, source string, kept_tier string, num_frames int, reject_reasons array<string>, _bad string"
TRACK = "clip_id string, ok boolean, path double, disp double, diag double, tort double, straight double, rot_deg double, fov_sweep double, vel_med double, vel_p95 double"
