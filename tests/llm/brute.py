"""Plain Python versions of the operators, for small inputs."""

import re
from collections import Counter, defaultdict

import numpy as np

TOP = 300


def grams(text):
    found = Counter()
    for word in re.findall(r"[^\W\d_]+", (text or "").lower()) if text else []:
        padded = f" {word} "
        for c in word:
            found[c] += 1
        for i in range(len(padded) - 1):
            found[padded[i : i + 2]] += 1
        for i in range(len(padded) - 2):
            found[padded[i : i + 3]] += 1
    return found


def code(gram):
    out = 0
    for c in gram:
        out = out << 21 | ord(c)
    return out


def ranked(counts):
    return sorted(counts, key=lambda g: (-counts[g], code(g)))[:TOP]


def profiles(rows):
    counts = defaultdict(Counter)
    for text, lang in rows:
        if lang is not None and text is not None:
            counts[lang].update(grams(text))
    return {lang: {g: i for i, g in enumerate(ranked(c))} for lang, c in counts.items()}


def language(text, known):
    own = ranked(grams(text))
    if not own:
        return "und", 0.0
    away = sorted((sum(abs(i - p[g]) if g in p else TOP for i, g in enumerate(own)) / (len(own) * TOP), lang) for lang, p in known.items())
    return away[0][1], away[1][0] - away[0][0] if len(away) > 1 else 1.0


def shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]+", lambda m: m.group().lower(), (text or "").encode()))
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def components(rows):
    """{id: (n, component)} of (id, text) rows with unique ids."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(set)
    for i, s in sets.items():
        for x in s:
            holders[x].add(i)
    pairs = Counter()
    for ids in holders.values():
        ids = sorted(ids)
        pairs.update((a, b) for k, a in enumerate(ids) for b in ids[k + 1 :])
    for (a, b), c in pairs.items():
        if 100 * c >= 80 * (len(sets[a]) + len(sets[b]) - c):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def edit_search(pattern, text):
    """Smallest edit distance of the pattern to a substring of text."""
    letters = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    steps = np.arange(len(letters) + 1)
    row = np.zeros(len(letters) + 1, np.int64)
    for i, c in enumerate(pattern, 1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (letters != ord(c)))
        row = np.minimum.accumulate(new - steps) + steps
    return int(row.min())


def contaminated(text, items, rate=0.1, least=24):
    text = " ".join((text or "").lower().split())
    found = {}
    for i, item in items:
        item = " ".join((item or "").lower().split())
        if len(item) >= least and (d := edit_search(item, text)) <= int(rate * len(item)):
            found[i] = d
    return found


PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def valid(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def base_spans(text):
    return [(k, m.start(), m.end()) for k in PII for m in re.finditer(PII[k], text or "") if valid(k, m.group())]


FOUND = [*PII, "secret"]
NAMES = "(password|passwd|secret|token|api_?key)"


def is_secret(left, text):
    bare = re.sub(r"[^A-Za-z0-9]+$", "", text)
    if re.fullmatch(r"[^A-Za-z0-9]*AKIA[0-9A-Z]{16}", bare):
        return True
    if re.fullmatch(rf"(?i:{NAMES})[=:]['\"]?[0-9a-fA-F]{{16,}}", bare):
        return True
    return re.fullmatch(r"['\"]?[0-9a-fA-F]{16,}", bare) is not None and re.search(NAMES + " ?[=:]$", left) is not None


def affix(text):
    if m := re.match("[A-Za-z_-]{2,32}[=:]", text):
        return m.group()
    if re.fullmatch("[0-9A-Z]{16,}", re.sub(r"[^A-Za-z0-9]+$", "", text)) and re.match("[A-Z]{4}", text):
        return text[:4]
    return ""


def all_spans(texts, rounds=3, least_seeds=3, smoothing=1.0, least=0.6):
    """Spans of every text, those of bootstrapped patterns included, in (kind, start) order."""
    uses, edges = [], set()
    for n, text in enumerate(texts):
        base, last = base_spans(text), 0
        for m in re.finditer(r"(?<!\S)\S*[0-9@]\S*", text or ""):
            before = re.search(r"(\S+\s+\S+)\s*$", text[last : m.start()])
            last = m.end()
            left = re.sub(r"\s+", " ", before.group(1)).lower() if before else ""
            seed = next((k for k in PII for b in base if b[0] == k and b[1] < m.end() and m.start() < b[2]), None)
            if seed is None and is_secret(left, m.group()):
                seed = "secret"
            patterns = [p for p in (left, affix(m.group()) and "^" + affix(m.group())) if p]
            uses.append((n, m.start(), m.end(), patterns, seed))
            edges |= {(p, m.group(), seed) for p in patterns}
    strings = defaultdict(set)
    for p, text, _ in edges:
        strings[p].add(text)
    seeds, seeded = {}, defaultdict(set)
    for p, text, seed in edges:
        if seed is not None:
            seeds[text] = min(seed, seeds.get(text, seed))
            seeded[p, seed].add(text)
    conf = {(p, k): len(t) / (len(strings[p]) + smoothing) for (p, k), t in seeded.items() if len(t) >= least_seeds}
    for _ in range(rounds):
        belief = {(t, k): 1.0 for t, k in seeds.items()}
        for (p, k), c in conf.items():
            if c >= least:
                for t in strings[p] - seeds.keys():
                    belief[t, k] = 1 - (1 - belief.get((t, k), 0.0)) * (1 - c)
        held = defaultdict(list)
        for p, some in strings.items():
            for k in FOUND:
                held[p, k] = [belief[t, k] for t in some if (t, k) in belief]
        conf = {(p, k): sum(b) / (len(strings[p]) + smoothing) for (p, k), b in held.items() if (p, k) in conf or sum(x >= least for x in b) >= least_seeds}
    chosen = {}
    for (p, k), c in conf.items():
        if c >= least:
            chosen[p] = min(chosen.get(p, (0.0, 0)), (-c, FOUND.index(k)))
    out = [[(FOUND.index(k), a, b) for k, a, b in base_spans(t)] for t in texts]
    for n, a, b, patterns, seed in uses:
        kinds = [chosen[p] for p in patterns if p in chosen]
        if seed in (None, "secret") and kinds:
            out[n].append((min(kinds)[1], a, b))
    return [sorted(s) for s in out]


def masked(text, spans):
    if not spans:
        return text
    out, at = "", 0
    for a, b, k in sorted((a, b, k) for k, a, b in spans):
        if a >= at:
            out += text[at:a] + f"<{FOUND[k]}>"
        at = max(at, b)
    return out + text[at:]
