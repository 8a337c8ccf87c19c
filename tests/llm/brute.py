"""Plain Python answers the operators are held against."""

import hashlib
import math
import re

import xxhash

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def remove_repeats(rows, window=13):
    least = {}
    split = [(d, SPACE_WORD.findall(t or "")) for d, t in rows]
    for d, ws in split:
        for i in range(len(ws) - window + 1):
            key = tuple(ws[i : i + window])
            if d is not None:
                least[key] = min(least.get(key, d), d)
    out = []
    for d, ws in split:
        gone = set()
        for i in range(len(ws) - window + 1):
            m = least.get(tuple(ws[i : i + window]))
            if d is not None and m is not None and m < d:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(ws) if i not in gone)
        out.append((d, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def quality(rows):
    out = []
    for d, t in rows:
        t = t or ""
        ws = SPACE_WORD.findall(t)
        seen, dup = set(), 0
        for line in t.split("\n"):
            if SPACE_WORD.search(line):
                dup += line in seen
                seen.add(line)
        places = {}
        for i in range(len(ws) - 4):
            places.setdefault(tuple(ws[i : i + 5]), []).append(i)
        again = {j for p in places.values() if len(p) > 1 for i in p for j in range(i, i + 5)}
        symbols = sum(t.count(c) for c in "#*$%&|<>")
        failed = len(ws) < 10 or 100 * len(again) > 20 * len(ws)
        out.append((d, len(ws), sum(map(len, ws)), symbols, dup, len(again), failed))
    return out


def contamination(rows, items, window=13):
    wanted = {}
    for item, text in items:
        ws = ALNUM_WORD.findall(lower(text))
        for i in range(max(1, len(ws) - window + 1) if ws else 0):
            wanted.setdefault(tuple(ws[i : i + window]), set()).update([] if item is None else [str(item)])
    sizes = sorted({len(k) for k in wanted})
    out = []
    for d, t in rows:
        ws = ALNUM_WORD.findall(lower(t))
        hit, seen = set(), set()
        for n in sizes:
            for i in range(len(ws) - n + 1):
                found = wanted.get(tuple(ws[i : i + n]))
                if found is not None:
                    hit.update(range(i, i + n))
                    seen |= found
        digest = hashlib.sha256(",".join(sorted(seen)).encode()).hexdigest()
        out.append((d, len(ws), len(hit), len(seen), digest, bool(hit) and 20 * len(hit) >= len(ws)))
    return out


def near_copies(rows, shingle=3, percent=85):
    """Links by way of shared shingles, so all pairs that have one in common are looked at."""
    sets, by_set = [], {}
    for i, (_, t) in enumerate(rows):
        ws = SPACE_WORD.findall(lower(t))
        grams = {tuple(ws[j : j + shingle]) for j in range(max(1, len(ws) - shingle + 1))} if ws else set()
        sets.append(frozenset(grams))
        if grams:
            by_set.setdefault(sets[-1], []).append(i)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    places = {}
    for s, members in by_set.items():
        for m in members[1:]:
            parent[root(m)] = root(members[0])
        for g in s:
            places.setdefault(g, []).append(members[0])
    for s, members in by_set.items():
        common = {}
        for g in s:
            for o in places[g]:
                if o > members[0]:
                    common[o] = common.get(o, 0) + 1
        for o, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[o]) - n):
                parent[root(o)] = root(members[0])
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [(d, len(sets[i]), least.get(root(i)), d == least.get(root(i))) for i, (d, _) in enumerate(rows)]


def license_phrases(rows, phrases=(("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))):
    out = []
    for d, t in rows:
        ws = ALNUM_WORD.findall(lower(t))
        places, labels = [], set()
        for phrase, label in phrases:
            p = phrase.split()
            at = [i for i in range(len(ws) - len(p) + 1) if ws[i : i + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        ends = (min(places), max(places)) if places else (None, None)
        out.append((d, len(ws), len(places), *ends, ",".join(sorted(labels))))
    return out


def personal_data(rows):
    patterns = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    )

    def passes(kind, found):
        digits = [int(c) for c in found if c.isascii() and c.isdigit()]
        if kind == "ip":
            return all(int(p) <= 255 for p in found.split("."))
        if kind == "card":
            doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
            return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    out = []
    for d, t in rows:
        spans, counts = [], []
        for order, (kind, pattern) in enumerate(patterns):
            found = [m for m in re.finditer(pattern, t or "") if passes(kind, m[0])]
            counts.append(len(found))
            spans += [(m.start(), order, f"{kind}:{m.start()}:{m.end()}") for m in found]
        text = ",".join(s[2] for s in sorted(spans))
        out.append((d, *counts, hashlib.sha256(text.encode()).hexdigest()))
    return out


def warc(pages, least=1000):
    first = {}
    for p, html in pages:
        raw = (html or "").encode()
        if len(raw) >= least and p is not None:
            first[raw] = max(first.get(raw, p), p)
    out = []
    for p, html in pages:
        raw = (html or "").encode()
        response = first.get(raw, p)
        kind = "response" if response == p else "revisit"
        out.append((p, len(raw), hashlib.sha1(raw).hexdigest(), kind, None if response == p else response))
    return out


def spark_hash(*values):
    """The 64-bit hash Spark gives to columns: long for int, ``(value,)`` for a 32-bit number, str, or None."""
    h = 42
    for v in values:
        if isinstance(v, tuple):
            h = xxhash.xxh64_intdigest(v[0].to_bytes(4, "little", signed=True), h)
        elif isinstance(v, str):
            h = xxhash.xxh64_intdigest(v.encode(), h)
        elif v is not None:
            h = xxhash.xxh64_intdigest(v.to_bytes(8, "little", signed=True), h)
    return h


def _signed(h):
    return h - (1 << 64) if h >= 1 << 63 else h


def mixture(rows, block=128, weights=(3, 1, 2), share=1.5, most=2, seed=0):
    """``doc_id, source, size, target, taken`` of (doc_id, text, source), block by block."""
    docs, copies = [], {}
    for d, t, source in rows:
        row = _signed(spark_hash(t))
        size = len(SPACE_WORD.findall(t or ""))
        copy = copies[d, source, row] = copies.get((d, source, row), 0) + 1
        docs.append((d, source, size, row, copy))
    total = {}
    for _, source, size, _, _ in docs:
        total[source] = total.get(source, 0) + size
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    goal, full = {}, set()
    while True:  # what is cut off is shared again by weight
        left = share * sum(total.values()) - sum(most * total[s] for s in full)
        rest = sum(weight[s] for s in order if s not in full)
        goal = {s: most * total[s] if s in full else left * weight[s] / rest for s in order}
        more = {s for s in order if goal[s] > most * total[s]}
        if not more:
            break
        full |= more
        if len(full) == len(order):
            goal = {s: most * total[s] for s in order}
            break
    taken = dict.fromkeys(range(len(docs)), 0)
    for s in order:
        for turn in range(1, math.ceil(goal[s] / total[s]) + 1 if total[s] else 1):
            blocks = []
            for i, (d, source, size, row, copy) in enumerate(docs):
                if source == s:
                    for b in range(-(-size // block)):
                        h = spark_hash(d, row, source, copy, b, turn, (seed,))
                        blocks.append((h >> 1, _signed(h), d is not None, d, row, copy, b, min(block, size - b * block), i))
            before = 0
            for *_, words, i in sorted(blocks):
                if before + words / 2 <= goal[s] - (turn - 1) * total[s]:
                    taken[i] += words
                before += words
    return [(d, source, size, goal[source], taken[i]) for i, (d, source, size, _, _) in enumerate(docs)]
