"""Personal data: base patterns, and bootstrapped contextual extraction.

Everything here is DataFrame and SQL functions.

Base spans of four kinds come from regular expressions and checks on each match.
They are seeds, and so are the credentials that SECRET_SEEDS describes, of a fifth
kind.  An identifier candidate is a white-space token with a digit or ``@``.  Its
lexical patterns are the two words before it, lower-cased, and the affix that it
begins with: a name up to ``=`` or ``:``, or the four first capitals of a long code.
Patterns and candidate strings form a bipartite graph whose scores are computed in turn:

* a seed string has confidence 1 for its kind, any other string the noisy-or of
  its patterns' confidences;
* a pattern's confidence for a kind is the confidence of its distinct strings over
  their number plus ``smoothing``, once it holds at least ``least_seeds`` believed strings of that
  kind: seeds, and from the first round on strings of at least ``least_confidence``.

So each round may admit patterns through strings that the round before discovered.

After ``rounds`` rounds, candidates behind patterns of at least ``least_confidence``
become spans of the pattern's kind, unless they overlap a base span; of two such
patterns the more confident one names the kind.  Secrets are thus spans only where
a pattern is believed, never by their form alone.

Null text counts as empty.  Counting distinct strings makes copies of a document
count once; equal rows get equal results; ties between kinds go to the first kind.
An empty table gives an empty table.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

KINDS = ("email", "ip", "card", "phone")
#: Kinds of spans that patterns may add; the last has no base spans.
FOUND = (*KINDS, "secret")

# Possessive quantifiers and look-behinds change no match; they keep the search linear in the text's length.
_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
#: Seeds of secrets, told from a token and the two words before it: a public form of access key, and long hexadecimal values given to names of credentials.
_NAME = "(?:password|passwd|secret|token|api_?key)"
_HEX = "[\"']?[0-9a-fA-F]{16,}+[^A-Za-z0-9]*+$"
SECRET_SEEDS = (r"^[^A-Za-z0-9]*+AKIA[0-9A-Z]{16}[^A-Za-z0-9]*+$", rf"^(?i:{_NAME})[=:]{_HEX}", rf"^{_HEX}")
SECRET_LEFT = rf"{_NAME} ?[=:]$"
AFFIX = "^([A-Za-z_-]{2,32}[=:]|[A-Z]{4}(?=[0-9A-Z]{12,}+[^A-Za-z0-9]*+$))"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

#: Texts with spans, and spans in all, that may be broadcast (some 20 MB); more are joined by shuffling.
BROADCAST_ROWS = 100_000
BROADCAST_SPANS = 400_000
#: Matches whose places are summed up at once.
CHUNK = 256
SPAN = "array<struct<start: int, end: int, text: string>>"


def _matches(text: Column, regex: str) -> Column:
    return F.regexp_extract_all(text, F.lit(regex), F.lit(0))


def _spans(text: Column, regex: str, matches: Column) -> Column:
    """Matches with their places in code points: lengths of what lies between them, summed up.

    Sums run over stretches of CHUNK matches, so that a text with very many costs little more than a scan.
    """
    steps = F.arrays_zip(F.slice(F.split(text, regex, -1), F.lit(1), F.size(matches)).alias("gap"), matches.alias("text"))
    part = f"struct<at: int, spans: {SPAN}>"

    def step(acc: Column, x: Column) -> Column:
        begin = (acc["at"] + F.length(x["gap"])).cast("int")
        end = (begin + F.length(x["text"])).cast("int")
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(F.struct(begin.alias("start"), end.alias("end"), x["text"].alias("text")))).alias("spans"))

    def stretch(parts: Column, i: Column) -> Column:
        start = F.struct(F.element_at(parts, -1)["at"].alias("at"), F.array().cast(SPAN).alias("spans")).cast(part)
        return F.concat(parts, F.array(F.aggregate(F.slice(steps, i * CHUNK + 1, F.lit(CHUNK)), start, step)))

    first = F.array(F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans")).cast(part))
    parts = F.aggregate(F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / CHUNK).cast("int")), first, stretch)
    return F.when(F.size(matches) > 0, F.flatten(F.transform(parts, lambda p: p["spans"]))).otherwise(F.array().cast(SPAN))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, text: Column) -> Column:
    if kind == "ip":
        return text.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        n = F.length(_digits(text))
        return F.when((n >= 16) & (n <= 19), luhn(_digits(text))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(text)).between(8, 15)
    return F.lit(True)


def _checked(kind: str, spans: Column) -> Column:
    return F.filter(spans, lambda s: _valid(kind, s["text"]))


def _numbered(kind: int, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def _count(kind: int, spans: Column) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def base_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with one array column of (start, end, text) per kind, and ``tokens``, the candidates as (left, start, end, text)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    digit = text.rlike("[0-9]")
    none = F.array().cast("array<string>")
    found = docs.withColumn("_text", text).select(
        "*",
        F.when(F.contains(text, F.lit("@")), _matches(text, EMAIL)).otherwise(none).alias("_email"),
        F.when(digit, _matches(text, IP)).otherwise(none).alias("_ip"),
        F.when(digit, _matches(text, CARD)).otherwise(none).alias("_card"),
        F.when(F.contains(text, F.lit("+")), _matches(text, PHONE)).otherwise(none).alias("_phone"),
        F.when(digit | F.contains(text, F.lit("@")), _matches(text, TOKEN)).otherwise(none).alias("_token"),
    )
    patterns = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
    kinds = [_checked(k, _spans(F.col("_text"), patterns[k], F.col(f"_{k}"))).alias(k) for k in KINDS]
    gaps = F.slice(F.split(F.col("_text"), TOKEN, -1), F.lit(1), F.size("_token"))
    left = F.transform(gaps, lambda g: F.lower(F.regexp_replace(F.regexp_extract(g, r"(\S++\s++\S++)\s*+$", 1), r"\s+", " ")))
    spans = _spans(F.col("_text"), TOKEN, F.col("_token"))
    tokens = F.when(F.size("_token") > 0, F.zip_with(left, spans, lambda p, s: F.struct(p.alias("left"), s["start"].alias("start"), s["end"].alias("end"), s["text"].alias("text")))).otherwise(F.array().cast("array<struct<left: string, start: int, end: int, text: string>>"))
    return found.select(*(c for c in docs.columns if c != text_col), *kinds, tokens.alias("tokens"))


def _overlap(spans: Column, start: Column, end: Column) -> Column:
    return F.exists(spans, lambda s: (s["start"] < end) & (start < s["end"]))


def _seed(token: Column) -> Column:
    """The first kind with a base span that overlaps the token, or secret, or null."""
    key, named, value = (token["text"].rlike(p) for p in SECRET_SEEDS)
    secret = F.when(key | named | (value & token["left"].rlike(SECRET_LEFT)), "secret")
    return reduce(lambda rest, k: F.when(_overlap(F.col(k), token["start"], token["end"]), k).otherwise(rest), reversed(KINDS), secret)


def _patterns(token: Column) -> Column:
    """The token's patterns: two words, which hold a space, and an affix, marked by a caret."""
    affix = F.regexp_extract(token["text"], AFFIX, 1)
    return F.filter(F.array(token["left"], F.when(affix != "", F.concat(F.lit("^"), affix)).otherwise("")), lambda p: p != "")


def score_patterns(edges: DataFrame, rounds: int = 3, least_seeds: int = 3, smoothing: float = 1.0, least_confidence: float = 0.6) -> DataFrame:
    """(left, kind, confidence) of patterns, from distinct edges (left, text, seed): seed is a kind or null."""
    edges = materialize(edges, "pii_edges")
    pairs = edges.select("left", "text").distinct()
    kinds = edges.groupBy("text").agg(F.min("seed").alias("seed"))
    size = pairs.groupBy("left").agg(F.count("*").alias("n"))
    seeds = edges.where("seed is not null").groupBy("left", F.col("seed").alias("kind")).agg(F.countDistinct("text").alias("seeds")).where(F.col("seeds") >= least_seeds)
    patterns = seeds.join(size, "left").select("left", "kind", (F.col("seeds") / (F.col("n") + smoothing)).alias("confidence"))
    # a seed string counts for its own kind alone
    own = kinds.where("seed is not null").select("text", F.col("seed").alias("kind"), F.lit(1.0).alias("belief"))
    for _ in range(rounds):
        patterns = materialize(patterns, "pii_patterns")
        # noisy-or of patterns that are believed
        found = pairs.join(patterns.where(F.col("confidence") >= least_confidence), "left").join(kinds.where("seed is null"), "text").groupBy("text", "kind").agg((1 - F.product(1 - F.col("confidence"))).alias("belief"))
        # believed strings meet all their patterns, so discovered ones admit new patterns too
        held = pairs.join(own.unionByName(found), "text").groupBy("left", "kind").agg(F.sum("belief").alias("total"), F.count_if(F.col("belief") >= least_confidence).alias("believed"))
        known = patterns.select("left", "kind", F.lit(True).alias("known"))
        grown = held.join(known, ["left", "kind"], "full").where(F.col("known") | (F.col("believed") >= least_seeds))
        patterns = grown.join(size, "left").select("left", "kind", (F.coalesce("total", F.lit(0.0)) / (F.col("n") + smoothing)).alias("confidence"))
    best = Window.partitionBy("left").orderBy(F.col("confidence").desc(), F.array_position(F.array(*map(F.lit, FOUND)), F.col("kind")))
    return patterns.where(F.col("confidence") >= least_confidence).withColumn("r", F.row_number().over(best)).where("r = 1").select("left", "kind", "confidence")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, FOUND)), s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 3, least_seeds: int = 3, least_confidence: float = 0.6) -> DataFrame:
    """One row per document: id, base and found (arrays of (kind number, start, end), sorted), pattern-found spans included in ``found``."""
    rows = base_spans(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("row", F.monotonically_increasing_id()))
    rows = materialize(rows, "pii_rows")
    numbered = [_numbered(i, F.col(k)) for i, k in enumerate(KINDS)]
    base = F.array_sort(F.concat(*numbered))
    # seeds are told inside the array, so that exploded rows are short whatever the text
    named = F.transform("tokens", lambda t: F.struct(_patterns(t).alias("patterns"), t["text"].alias("text"), t["start"].alias("start"), t["end"].alias("end"), _seed(t).alias("seed")))
    told = rows.where(F.size("tokens") > 0).select("row", F.filter(named, lambda t: F.size(t["patterns"]) > 0).alias("tokens"))
    uses = told.select("row", F.explode("tokens").alias("t")).select("row", F.explode("t.patterns").alias("left"), "t.text", "t.start", "t.end", "t.seed")
    patterns = score_patterns(uses.select("left", "text", "seed").distinct(), rounds, least_seeds, least_confidence=least_confidence)
    number = F.array_position(F.array(*map(F.lit, FOUND)), F.col("kind")).cast("int") - 1
    open_uses = uses.where("seed is null or seed = 'secret'").select("row", "left", "start", "end")
    chosen = open_uses.join(patterns, "left").groupBy("row", "start", "end").agg(F.min_by(number, F.struct(-F.col("confidence"), number)).alias("kind"))
    new = chosen.groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("new"))
    none = F.array().cast("array<struct<kind: int, start: int, end: int>>")
    return rows.select("row", "id", base.alias("base")).join(new, "row", "left").select(F.col("id").alias(id_col), "base", F.array_sort(F.concat("base", F.coalesce("new", none))).alias("found"))


def pii_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of base spans per kind, the hash of the base spans, all spans as text and their number."""
    counts = [_count(i, F.col("base")).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select(id_col, *counts, F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"), F.size("found").cast("long").alias("n_spans"))


def mask(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """docs with every found span replaced by its kind in angle brackets; ``n_chars``, if there, follows the text.

    Spans depend on the text alone, so they are found once per distinct text and joined by its hash.
    """
    found_col, digest_col, masked_col = (f"_{name}_{uuid.uuid4().hex}" for name in ("found", "digest", "masked"))  # names that docs doesn't have
    digest = F.sha2(F.col(text_col).cast("binary"), 256)
    texts = docs.where(F.col(text_col).isNotNull()).select(digest.alias("id"), F.col(text_col).alias("text"))
    found = materialize(find_pii(texts, "id", "text", **options).where(F.size("found") > 0).groupBy("id").agg(F.first("found").alias(found_col)), "pii_found")
    side = found.withColumnRenamed("id", digest_col)
    n_texts, n_spans = found.agg(F.count("*"), F.coalesce(F.sum(F.size(found_col)), F.lit(0))).first()
    if n_texts <= BROADCAST_ROWS and n_spans <= BROADCAST_SPANS:
        side = F.broadcast(side)
    text = F.col(text_col)
    names = F.array(*map(F.lit, FOUND))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))

    def step(acc: Column, s: Column) -> Column:
        # a span that begins inside an earlier one only lengthens it
        gap = F.when(s["start"] >= acc["at"], F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("<"), F.element_at(names, s["kind"] + 1), F.lit(">"))).otherwise("")
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["text"], gap).alias("text"))

    by_place = F.array_sort(F.transform(found_col, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    tail = lambda done: F.concat(done["text"], F.substring(text, done["at"] + 1, F.length(text)))
    masked = F.aggregate(by_place, start, step, tail)
    out = docs.withColumn(digest_col, digest).join(side, digest_col, "left").withColumn(masked_col, F.when(F.col(found_col).isNull(), text).otherwise(masked))
    new = {text_col: F.col(masked_col)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col(found_col).isNull(), F.col("n_chars")).otherwise(F.length(masked_col).cast(docs.schema["n_chars"].dataType))
    return out.select(*(new.get(c, F.col(c)).alias(c) for c in docs.columns))
