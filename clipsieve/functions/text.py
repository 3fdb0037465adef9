"""Caption and annotation text rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Terms that place a scene under a roof; one is enough.
INDOOR = (
    "indoor", "indoors", "interior", "ceiling", "atrium", "lobby", "hallway", "corridor",
    "showroom", "warehouse", "shopping mall", "exhibition hall", "market hall",
    "concourse", "foyer", "vestibule", "inside the building", "escalator",
    "living room", "bedroom", "bathroom", "kitchen", "office space", "classroom",
)
# Terms that place a scene in the open; two different ones are needed.
OUTDOOR = (
    "sky", "clouds", "sunlight", "daylight", "street", "streets", "road", "roadway",
    "sidewalk", "pavement", "outdoor", "outdoors", "crosswalk", "alley", "plaza",
    "courtyard", "boardwalk", "harbor", "harbour", "waterfront", "park", "forest",
    "woods", "trail", "path", "river", "lake", "ocean", "beach", "desert", "valley",
    "mountain", "hillside", "snow-covered", "trees", "vegetation", "foliage", "grass",
    "facade", "facades", "storefronts", "balconies", "rooftop", "skyline", "horizon",
    "parking lot", "bridge", "canal", "field",
)
# Wording of camera motion.
CAMERA_MOTION = (
    r"\bpan(s|ning|ned)?\b", r"\btilt(s|ing|ed)?\b", r"\bzoom(s|ing|ed)?\b",
    r"\bdolly(ing)?\b", r"\btrack(ing|s|ed)?\s+shot\b", r"\borbit(s|ing|ed)?\b",
    r"\bcrane\s+shot\b", r"\bpush(es|ing)?\s+in\b", r"\bpull(s|ing)?\s+out\b",
    r"\bmove(s|ing)?\s+(forward|backward|left|right|up|down)\b",
    r"\bcamera\s+(moves?|pans?|tilts?|rotat\w+|fl(y|ies|ying)|trucks?|pushes?)\b",
    r"\b(fly(s|ing)?\s+through|flythrough)\b", r"\brotat(e|es|ing)\s+around\b",
    r"\bfollow(s|ing)?\s+shot\b", r"\bhandheld\b", r"\bsteadicam\b",
)
# Wording an annotation caption may not have, by name.
FORBIDDEN_WORDING = {
    "video_game": r"\bvideo game\b", "game": r"\bgame\b", "render": r"\brender(?:ed)?\b", "cgi": r"\bcgi\b",
    "animation": r"\banimat(?:ion|ed)\b", "screenshot": r"\bscreenshot\b", "hud": r"\bhud\b",
    "third_person_view": r"\bthird-person view\b", "video": r"\bvideo\b", "image": r"\bimage\b", "clip": r"\bclip\b",
    "footage": r"\bfootage\b", "person_people": r"\b(?:person|people|human|humans|man|men|woman|women|boy|boys|girl|girls)\b",
    "crowd": r"\bcrowds?\b", "clothing": r"\bclothing\b", "animal": r"\banimals?\b", "bird": r"\bbirds?\b",
    "insect": r"\binsects?\b", "driving": r"\bdriv(?:e|es|ing|en)\b", "passing": r"\bpass(?:es|ing|ed)?\b",
    "turning": r"\bturn(?:s|ing|ed)?\b", "arriving": r"\barriv(?:e|es|ing|ed)\b", "departing": r"\bdepart(?:s|ing|ed)?\b",
    "traffic_flow": r"\btraffic flow\b", "camera": r"\bcamera\b", "pan": r"\bpan(?:s|ning|ned)?\b",
    "tilt": r"\btilt(?:s|ing|ed)?\b", "zoom": r"\bzoom(?:s|ing|ed)?\b", "dolly": r"\bdolly\b", "orbit": r"\borbit(?:s|ing|ed)?\b",
    "tracking": r"\btracking\b", "moving_forward": r"\bmoving forward\b", "moving_backward": r"\bmoving backward\b",
    "viewpoint": r"\bviewpoints?\b", "framing": r"\bframing\b", "perspective": r"\bperspective changes?\b",
    "shot_type": r"\bshot types?\b", "likely": r"\blikely\b", "perhaps": r"\bperhaps\b", "suggests": r"\bsuggests\b",
    "appears_to_be": r"\bappears to be\b", "seems": r"\bseems\b", "ideal_for": r"\bideal for\b", "overall_appearance": r"\boverall appearance\b",
}
WORD = r"[A-Za-z0-9]+(?:[-'][A-Za-z0-9]+)*"
_MOTION = "(?i)" + "|".join(CAMERA_MOTION)


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+|\s+$", "")


def word_count(text: Column) -> Column:
    """Words of letters and digits, with inner hyphens and apostrophes."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD))


def blank_separated_count(text: Column) -> Column:
    t = strip(text)
    return F.when(t == "", 0).otherwise(F.size(F.split(t, r"\s+")))


def outdoor_class(caption: Column) -> Column:
    """outdoor, indoor or unclear. The folded caption is bound once, then looked through term by term."""
    folded = F.regexp_replace(F.lower(strip(caption)), r"\s+", " ")
    verdict = lambda c: (
        F.when(F.exists(F.array(*map(F.lit, INDOOR)), lambda t: F.contains(c, t)), "indoor")
        .when(F.size(F.filter(F.array(*map(F.lit, OUTDOOR)), lambda t: F.contains(c, t))) >= 2, "outdoor")
        .otherwise("unclear")
    )
    return F.transform(F.array(folded), verdict)[0]


def has_camera_motion(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(_MOTION)


def strip_camera_motion(text: Column) -> Column:
    t = F.regexp_replace(F.coalesce(text, F.lit("")), _MOTION, "")
    t = F.regexp_replace(t, r"\s{2,}", " ")
    t = F.regexp_replace(t, r"\s+([,.;])", "$1")
    t = F.regexp_replace(t, r"([,;]\s*){2,}", ", ")
    return strip(F.btrim(t, F.lit(" ,;.")))


def forbidden_wording(text: Column) -> Column:
    """Names of the forbidden patterns that a caption has, in their order. All of them begin at a word, so that one pattern of all
    tells first whether there is any; most captions have none."""
    some = r"(?i)\b(?:" + "|".join(p.removeprefix(r"\b") for p in FORBIDDEN_WORDING.values()) + ")"
    named = F.filter(F.array(*[F.when(text.rlike("(?i)" + p), F.lit(n)) for n, p in FORBIDDEN_WORDING.items()]), lambda n: n.isNotNull())
    return F.when(text.rlike(some), named).otherwise(F.array().cast("array<string>"))


def drop_sentences(text: Column, words: list[str]) -> Column:
    """The sentences (cut at ". ") in which none of the words occurs."""
    any_of = "(?i)" + "|".join(rf"\b{w}\b" for w in words)
    return F.array_join(F.filter(F.split(text, r"\. "), lambda s: ~s.rlike(any_of)), ". ")


def unfence(text: Column) -> Column:
    """The inside of a text that is wholly one fenced block, else the stripped text."""
    t = strip(text)
    inner = F.regexp_extract(t, r"(?s)^```(?:json)?\s*\n(.*?)\n?```$", 1)
    return F.when(t.rlike(r"(?s)^```(?:json)?\s*\n.*```$"), inner).otherwise(t)


def with_full_stop(text: Column) -> Column:
    t = strip(text)
    return F.when(t.rlike(r"[.!?]$"), t).otherwise(F.concat(t, F.lit(".")))


def seconds_of_name(name: Column) -> Column:
    """Seconds since the epoch of a file name that ends in _<ISO time>.jpg; null where it does not."""
    return F.unix_micros(F.regexp_replace(F.substring_index(name, "_", -1), r"\.jpg$", "").try_cast("timestamp")) / 1e6


def plain_endpoint(url: Column) -> Column:
    """Whether a URL is http or https with a host, and without credentials, query or fragment."""
    return F.coalesce(url.rlike(r"^https?://[^/?#@\s]+(/[^?#@\s]*)?$"), F.lit(False))


def choose_caption(native: Column, ident: Column, templates: list[str]) -> Column:
    """The clip's own caption, else a template chosen by the first byte of the id's sha1; then stripped of camera wording."""
    pick = (F.conv(F.substring(F.sha1(ident.cast("string")), 1, 2), 16, 10).cast("int") % len(templates)).cast("int")
    return strip_camera_motion(F.when(strip(native) != "", native).otherwise(F.get(F.array(*map(F.lit, templates)), pick)))
