"""URL filters: explicit host/path rules, then a weighted vocabulary.

An Aho-Corasick automaton over strict and soft terms reads each URL after its
``://`` once, query string and fragment included.  A term counts where the characters on both sides are neither ASCII
letters nor digits.  One strict term, or ``soft_limit`` distinct soft terms,
blocks a URL that no rule covers.

Null URL, or one without ``://``: host and path are empty and no rule fits; the
vocabulary reads the whole of such a URL, and allows a null one.  Repeated rows are judged row by
row; an empty table gives an empty table; columns other than the two named are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import column

RULES = (
    ("block", "com/en/"),
    ("allow", "example.com/en/7"),
    ("allow", "net/de/"),
    ("block", "example.net/de/8"),
    ("block", "org/es/"),
)

#: The default vocabulary.
STRICT = ("ads-track", "casino", "cheap-pills", "escort", "hentai", "payday-loans", "porn", "porno", "viagra", "warez", "xxx")
SOFT = ("adult", "ads", "affiliate", "bet", "bonus", "cheap", "free", "lottery", "nude", "pills", "poker", "sex", "slots", "torrent", "track", "win")

_ALNUM = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): see the module's text for null and malformed URLs."""
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    ends = [i for i in map(rest.find, "/?#") if i >= 0]
    cut = min(ends, default=len(rest))
    host, tail = rest[:cut].translate(_LOWER), rest[cut:]
    ends = [i for i in map(tail.find, "?#") if i >= 0]
    return host, tail[: min(ends, default=len(tail))]


def searched_part(url: str | None) -> str:
    """What the vocabulary reads: all after the first ``://``, or the whole URL without one; A-Z lower-cased."""
    return (url or "").partition("://")[2 if "://" in (url or "") else 0].translate(_LOWER)


def rule_index(rules: Sequence[tuple[str, str]]) -> dict[str, list[tuple[str, str, str]]]:
    """Rules by host, each host's longest path first: (path, rule, verdict)."""
    by_host: dict[str, list[tuple[str, str, str]]] = {}
    for verdict, rule in rules:
        host, _, path = rule.partition("/")
        by_host.setdefault(host, []).append(("/" + path, rule, verdict))
    for found in by_host.values():
        found.sort(key=lambda r: (-len(r[0]), r[1]))
    return by_host


def match_rule(by_host: dict, host: str, path: str) -> tuple[str, str] | None:
    """The longest rule that fits the host or a parent of it: (rule, verdict)."""
    best, name = None, host
    while name:
        for prefix, rule, verdict in by_host.get(name, ()):
            if path.startswith(prefix):
                if best is None or len(rule) > len(best[0]):
                    best = (rule, verdict)
                break
        name = name.partition(".")[2]
    return best


def build_automaton(strict: Sequence[str], soft: Sequence[str]):
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for terms, hard in ((soft, False), (strict, True)):
        for term in terms:
            automaton.add_word(term.translate(_LOWER), (term.translate(_LOWER), hard))
    automaton.make_automaton()
    return automaton


def vocabulary_hits(automaton, text: str) -> tuple[set[str], set[str]]:
    """Distinct (strict, soft) terms with boundaries on both sides."""
    strict: set[str] = set()
    soft: set[str] = set()
    if not text or not len(automaton):
        return strict, soft
    for end, (term, hard) in automaton.iter(text):
        start = end - len(term)
        if (start < 0 or text[start] not in _ALNUM) and (end + 1 == len(text) or text[end + 1] not in _ALNUM):
            (strict if hard else soft).add(term)
    return strict, soft


def filter_urls(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: Sequence[tuple[str, str]] = RULES,
    strict: Sequence[str] = STRICT,
    soft: Sequence[str] = SOFT,
    soft_limit: int = 2,
) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, strict_hits, soft_hits."""
    by_host = rule_index(rules)
    id_type = pages.schema[id_col].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = build_automaton(strict, soft)
        for batch in batches:
            hosts, paths, fits, verdicts, n_strict, n_soft = [], [], [], [], [], []
            for url in column(batch, url_col):
                host, path = split_url(url)
                hard, weak = vocabulary_hits(automaton, searched_part(url))
                rule = match_rule(by_host, host, path)
                hosts.append(host)
                paths.append(path)
                fits.append(rule and rule[0])
                verdicts.append(rule[1] if rule else "block" if hard or len(weak) >= soft_limit else "allow")
                n_strict.append(len(hard))
                n_soft.append(len(weak))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(id_col)), *(pa.array(x, pa.string()) for x in (hosts, paths, fits, verdicts)), pa.array(n_strict, pa.int64()), pa.array(n_soft, pa.int64())],
                [id_col, "host", "path", "rule", "verdict", "strict_hits", "soft_hits"],
            )

    return pages.select(id_col, url_col).mapInArrow(judge, f"{id_col} {id_type}, host string, path string, rule string, verdict string, strict_hits long, soft_hits long")
