"""Scalar expressions: keys, text, arithmetic, vectors, JSON."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def slug(text: Column, most: int = 48) -> Column:
    """Lower case, every run outside letters and digits as one underscore, none at the ends."""
    return F.substring(F.regexp_replace(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", "_"), "^_+|_+$", ""), 1, most)


def stable_id(text: Column) -> Column:
    return F.replace(F.lower(F.trim(text)), F.lit(" "), F.lit("_"))


def safe_token(text: Column) -> Column:
    """ASCII letters and digits in lower case, every other run as one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def asset_id(modality: Column, stem: Column, sha256: Column) -> Column:
    return F.concat_ws("__", modality, slug(stem), F.substring(sha256, 1, 12))


def word_count(text: Column) -> Column:
    trimmed = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, " ")))


def token_count(text: Column) -> Column:
    """Runs of word characters with inner apostrophes and hyphens."""
    return F.regexp_count(text, F.lit(r"(?U)\b[\w'’-]+\b"))


#: Fixed value: a pause marker and its seconds.
PAUSE = r"\[pause:\s*([0-9]+(?:\.[0-9]+)?)s?\]"


def pauses(text: Column) -> Column:
    """Seconds of every ``[pause:x]`` marker, in order."""
    return F.transform(F.regexp_extract_all(text, F.lit(PAUSE), F.lit(1)), lambda s: s.cast("double"))


def without_pauses(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"\[pause:[^\]]*\]", ""), r"\s+", " "))


def candidate_number(name: Column) -> Column:
    found = F.regexp_extract(name, r"__candidate_(\d+)", 1)
    return F.when(found == "", 1).otherwise(found.cast("int"))


def base_task(name: Column) -> Column:
    return F.regexp_replace(name, r"__candidate_\d+.*$", "")


def rational(text: Column) -> Column:
    """``a/b`` or a number as double, rounded to 6 places; null for a zero denominator or other text."""
    parts = F.split(text, "/")
    top, bottom = parts[0].try_cast("double"), F.try_element_at(parts, F.lit(2)).try_cast("double")
    return F.bround(F.when(F.size(parts) == 2, F.try_divide(top, bottom)).otherwise(top), 6)


def snap_frames(frames: Column) -> Column:
    """The nearest 8n + 1, the lower one at a tie, 1 at least."""
    below = F.greatest(F.lit(1), F.floor((frames - 1) / 8) * 8 + 1)
    return F.when(frames - below > 4, below + 8).otherwise(below).cast("long")


def snap_down(value: Column, to: int = 8) -> Column:
    return F.greatest(F.lit(to), value - value % to)


def quality_score(width: Column, height: Column, contrast: Column, sharpness: Column, brightness: Column, places: int | None = 4) -> Column:
    """Sum of capped terms of size, contrast, sharpness and distance from mid brightness."""
    size = F.least(F.lit(30.0), 10 * F.log2(width * height / 1_000_000 + 1))
    total = size + F.least(F.lit(25.0), contrast / 2.5) + F.least(F.lit(30.0), sharpness * 1.5) + F.greatest(F.lit(0.0), 15 - F.abs(brightness - 128) / 8)
    return total if places is None else F.bround(total, places)


def clean_score(distance: Column, *flags: tuple[Column, float]) -> Column:
    """0.55 for a close distance (null and 0 read as 1.5) plus the shares of true flags, 1 at most."""
    d = F.when(distance.isNull() | (distance == 0), 1.5).otherwise(distance)
    total = 0.55 * F.greatest(F.lit(0.0), 1 - d / 1.5)
    for flag, share in flags:
        total = total + F.when(flag, share).otherwise(0.0)
    return F.least(F.lit(1.0), total)


def dbfs(rms: Column) -> Column:
    return 20 * F.log10(rms + 1e-12)


def words_per_minute(words: Column, seconds: Column) -> Column:
    return F.try_divide(words * 60.0, seconds)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda t, x: t + x)


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine; 1 where a vector has no length."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms == 0, 1.0).otherwise(1 - dot(a, b) / norms)


def normalised(v: Column) -> Column:
    norm = F.sqrt(dot(v, v))
    return F.transform(v, lambda x: F.when(norm == 0, 0.0).otherwise(x.cast("double") / norm))


def sorted_counts(pairs: Column) -> Column:
    """A map from (key, count) structs, keys ascending."""
    return F.map_from_entries(F.array_sort(pairs))


def in_order(text: Column, tokens: Sequence[str]) -> Column:
    """Whether all tokens occur and their first places ascend."""
    places = F.array(*(F.instr(text, t) for t in tokens))
    return ~F.exists(places, lambda p: p == 0) & (places == F.array_sort(places))


def canonical(text: Column, ladder: Sequence[tuple[str, str]], default: str) -> Column:
    """The value of the first substring that the lower-cased text holds."""
    out = F.lit(default)
    for part, value in reversed(list(ladder)):
        out = F.when(F.contains(F.lower(text), F.lit(part)), value).otherwise(out)
    return out


def json_errors(doc: Column, fields: Mapping[str, str]) -> Column:
    """Reasons against a JSON text: unreadable, or fields that are missing or of another type.

    fields: name to one of string, number, boolean, array, object.
    """
    value = F.try_parse_json(doc)
    kinds = {"string": ["STRING"], "number": ["BIGINT", "INT", "DOUBLE", "DECIMAL"], "boolean": ["BOOLEAN"], "array": ["ARRAY"], "object": ["OBJECT"]}
    checks = []
    for name, kind in fields.items():
        part = F.try_variant_get(value, f"$.{name}", "variant")
        seen = F.schema_of_variant(part)
        ok = _starts(seen, kinds[kind])
        checks += [F.when(value.isNotNull() & part.isNull(), F.lit(f"missing:{name}")), F.when(part.isNotNull() & ~ok, F.lit(f"type:{name}"))]
    return F.when(value.isNull(), F.array(F.lit("unreadable"))).otherwise(F.array_compact(F.array(*checks)))


def _starts(text: Column, prefixes: Sequence[str]) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | F.startswith(text, F.lit(p))
    return out


def scalar_or_list(value: Column, empty: Sequence[str] = ("", "none", "null", "n/a")) -> Column:
    """A JSON scalar or list as an array of strings, null tokens left out."""
    listed = F.coalesce(F.from_json(value, "array<string>"), F.array(value))
    return F.filter(listed, lambda x: x.isNotNull() & ~F.lower(F.trim(x)).isin(list(empty)))


def first_segment(path: Column) -> Column:
    return F.split_part(path, F.lit("/"), F.lit(1))


#: Ordered ladders of substrings for enumerated traits.
EXPRESSIONS = [(v, v) for v in ("neutral", "smiling", "laughing", "serious", "determined")]
HAIR_TEXTURES = [(v, v) for v in ("curly", "wavy", "straight", "coily")]
BODY_VISIBILITY = [
    ("full", "full_body"),
    ("leg", "three_quarter_body"),
    ("three-quarter", "three_quarter_body"),
    ("upper", "upper_body"),
    ("torso", "upper_body"),
    ("arm", "upper_body"),
    ("head", "head_and_shoulders"),
    ("neck", "head_and_shoulders"),
    ("shoulder", "head_and_shoulders"),
]


def view_name(text: Column) -> Column:
    """Profile, three-quarter and frontal views from free text."""
    t = F.lower(F.coalesce(text, F.lit("")))
    has = lambda *parts: _all(t, parts)
    return (
        F.when(has("profile", "left"), "left_profile")
        .when(has("profile", "right"), "right_profile")
        .when(has("three", "left"), "left_three_quarter")
        .when(has("three", "right"), "right_three_quarter")
        .when(has("front") | has("portrait") | has("interior"), "frontal")
        .otherwise("uncertain")
    )


def _all(text: Column, parts: Sequence[str]) -> Column:
    out = F.lit(True)
    for p in parts:
        out = out & F.contains(text, F.lit(p))
    return out


def facial_viewpoint(left_eye: Column, right_eye: Column, nose: Column) -> Column:
    """Coarse yaw from horizontal places of eyes and nose; null marks an unseen one."""
    low, high = F.least(left_eye, right_eye), F.greatest(left_eye, right_eye)
    at = (nose - low) / (high - low)
    return (
        F.when(left_eye.isNull() | right_eye.isNull() | nose.isNull(), "undetermined")
        .when(high - low <= 0.02, "profile_or_occluded")
        .when(at.between(0.38, 0.62), "frontal")
        .when(at.between(-0.15, 1.15), F.when(at < 0.5, "left_three_quarter").otherwise("right_three_quarter"))
        .otherwise("profile")
    )


def keyword_flags(text: Column, flags: Mapping[str, Sequence[str]], always: Sequence[str] = ()) -> Column:
    """Names whose keywords the lower-cased text holds, with those always set, sorted."""
    t = F.lower(text)
    hits = [F.when(t.rlike("|".join(f"(?:{w})" for w in words)), F.lit(name)) for name, words in flags.items()]
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*map(F.lit, always), *hits))))
