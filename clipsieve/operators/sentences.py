"""Wording policies of the four-field caption contract, as native expressions.

A guard is a pattern that no text field may hold. A rule looks for its trigger in one field, whole or sentence by
sentence, and may be excused by what stands before the trigger, after it, at once after it, or anywhere in the sentence. It may
hold only for one perspective, only in sentences that begin by an opening, only in the first of these, or only where the
description's first sentence declares a principal subject. Both are data; each becomes one regular expression, in which
the excuses are lookaheads, so a policy runs inside the projection and no row leaves the engine.

A null or malformed text of facts breaks no rule here (the contract itself reports it); fields that are no strings are passed over.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import unfence
from .wording import GUARDS, RULES, STATIC


@dataclass(frozen=True)
class Rule:
    name: str
    field: str
    trigger: str
    unless_before: str | None = None
    unless_after: str | None = None
    unless_next: str | None = None
    unless_in: str | None = None
    needs_before: str | None = None
    perspective: str | None = None
    opening: str | None = None  # the sentence must begin so; the trigger is sought in the rest
    unless_opening: str | None = None  # wording inside the opening that makes it none
    first_sentence: bool = False
    first_opening: bool = False  # only the first sentence that has the opening
    declared: str | None = None  # what the description's first sentence must begin with
    absent_field: str | None = None  # another field that must be a string without ``absent``
    absent: str | None = None
    stops: str = ".!?"  # empty: the field is not split

    def pattern(self) -> str:
        gap = f"(?:(?!{self.unless_before}).)*?" if self.unless_before else ".*?"
        head = rf"^\s*(?>{self.opening})" if self.opening else "^"
        if self.needs_before:
            head += f"(?=.*?(?:{self.needs_before}).*?(?:{self.trigger}))"
        tail = (f"(?!{self.unless_next})" if self.unless_next else "") + (f"(?!.*(?:{self.unless_after}))" if self.unless_after else "")
        return f"(?isU){head}{gap}(?:{self.trigger}){tail}"

    def broken(self, facts: Column) -> Column:
        text = facts[self.field]
        parts = F.split(text, f"[{self.stops}]") if self.stops else F.array(text)
        if self.first_sentence:
            parts = F.slice(parts, 1, 1)
        if self.first_opening:
            begins = lambda s: s.rlike(rf"(?isU)^\s*(?:{self.opening})") & (~s.rlike(rf"(?isU)^\s*(?=(?:{self.opening}))(?:{self.unless_opening})") if self.unless_opening else F.lit(True))
            parts = F.slice(F.filter(parts, begins), 1, 1)
        hit = lambda s: s.rlike(self.pattern()) & (~s.rlike(f"(?isU){self.unless_in}") if self.unless_in else F.lit(True))
        found = F.exists(parts, hit)
        if self.perspective:
            found = found & (facts["perspective_type"] == self.perspective)
        if self.declared:
            found = found & F.get(F.split(facts["scene_description"], "[.!?]"), F.lit(0)).rlike(rf"(?isU)^(?:{self.declared})")
        if self.absent_field:
            found = found & ~facts[self.absent_field].rlike(f"(?isU){self.absent}")
        return F.coalesce(found, F.lit(False))


STATIC_RULES = tuple(Rule(**r) for r in STATIC)
#: All rules of the contract, in the order in which they are reported.
POLICY_RULES = tuple(Rule(**r) for r in RULES)


def _facts(raw: Column) -> Column:
    """The four fields as strings; a field of another type is null."""
    v = F.try_parse_json(unfence(raw))
    only = lambda k: F.when(F.schema_of_variant(F.try_variant_get(v, f"$.{k}", "variant")) == "STRING", F.try_variant_get(v, f"$.{k}", "string")).alias(k)
    return F.struct(*[only(k) for k in ("perspective_type", "visual_style", "scene_description", "scene_dynamics")])


def sentence_errors(raw: Column, rules=STATIC_RULES) -> Column:
    """Names of the rules that a JSON text of facts breaks, in their order; a text that is no object breaks none."""
    found = lambda facts: F.filter(F.array(*[F.when(r.broken(facts), F.lit(r.name)) for r in rules]), lambda n: n.isNotNull())
    # the one-element array binds the parsed facts to a variable, so that they are read once
    return F.when(raw.isNotNull(), F.transform(F.array(_facts(raw)), found)[0]).otherwise(F.array().cast("array<string>"))


def guard_errors(raw: Column, guards: dict[str, tuple] = GUARDS) -> Column:
    """field:category:name of every guard that one of the three text fields matches, by field, then in the order of the guards."""

    def found(facts: Column) -> Column:
        hits = [F.when(facts[f].rlike(f"(?iU){p}"), F.lit(f"{f}:{kind}:{name}")) for f in ("visual_style", "scene_description", "scene_dynamics") for kind, named in guards.items() for name, p in named]
        return F.filter(F.array(*hits), lambda n: n.isNotNull())

    return F.when(raw.isNotNull(), F.transform(F.array(_facts(raw)), found)[0]).otherwise(F.array().cast("array<string>"))


def wording_errors(raw: Column) -> Column:
    """What a JSON text of facts breaks of the whole wording policy: guards, then rules."""
    return F.concat(guard_errors(raw), sentence_errors(raw, POLICY_RULES))
