"""Plain versions of the operators, over Python lists."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def byte_repeats(docs, length=100):
    """docs: (doc_id, text) with distinct ids. doc_id -> n_bytes, n_removed, n_spans, sha of the rest."""
    seen, out = set(), {}
    for doc, text in sorted(docs):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(window)
        spans = sum(g and not p for g, p in zip(gone, b"\0" + gone))
        out[doc] = (len(data), sum(gone), spans, sha(bytes(b for b, g in zip(data, gone) if not g)))
    return out


def word_repeats(docs, length=13):
    seen, out = set(), {}
    for doc, text in sorted(docs):
        w = words(text)
        gone, own = bytearray(len(w)), set()
        for i in range(len(w) - length + 1):
            window = tuple(w[i : i + length])
            if window in seen:
                gone[i : i + length] = b"\1" * length
            own.add(window)
        seen |= own
        out[doc] = (len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g).encode()))
    return out


def counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = words(text)
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines, dups = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dups += line in lines
            lines.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dups, len(covered)


def shingles(text, size=5):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(text)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1)))


def components(docs):
    """docs: (doc_id, text). doc_id -> n_shingles, smallest id linked with it."""
    sets = {doc: shingles(text) for doc, text in docs}
    root = {doc: doc for doc in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    places = defaultdict(list)
    for doc, own in sorted(sets.items()):
        near = Counter(other for s in own for other in places[s])
        for other, both in near.items():
            if 100 * both >= 80 * (len(own) + len(sets[other]) - both):
                a, b = sorted((find(doc), find(other)))
                root[b] = a
        for s in own:
            places[s].append(doc)
    return {doc: (len(own), find(doc)) for doc, own in sets.items()}


def targets(sizes):
    """sizes: source -> words. source -> target."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    names += [s for s in sizes if s is None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        out = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = [s for s in free if out[s] > 3 * sizes[s]]
        if not above:
            return fixed | out
        fixed |= {s: 3 * sizes[s] for s in above}


def word_runs(w):
    """All runs of a list of words as (start, length, period), by start, then period."""
    found = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.append((i, j + q - i, q))
            i = j + 1
    inside = lambda a, b: b[2] < a[2] and b[0] <= a[0] and a[0] + a[1] <= b[0] + b[1]
    return sorted((r for r in found if not any(inside(r, s) for s in found)), key=lambda r: (r[0], r[2]))


def loops(doc, text):
    """The words of a document after planting, as the query plants them."""
    w = words(text)
    h = zlib.crc32(str("" if doc is None else doc).encode())
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def run_row(doc, text):
    w = loops(doc, text)
    runs = word_runs(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    left = " ".join(x for i, x in enumerate(w) if i not in gone)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    milli = 1000 * best[1] // best[2] if runs else None
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (len(runs), *best, milli, sha(lines.encode()), sha(left.encode()))


def rebuilt(rows):
    """rows: (conv_id, turn, role, text). conv_id -> its rebuilt (role, text) turns."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(turns)] for c, turns in convs.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def trie(seqs):
    """conv_id -> turns. The trie's rows, as sorted tuples in the order of the query's columns."""
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        saved[p] = own + sum(saved[k] for k in kids[p])
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        ends = sorted(c for c in members[p] if len(seqs[c]) == len(p))
        parent = min(members[p[:-1]]) if p else None
        out.append((
            min(members[p]), len(p), parent, len(members[p]), len(kids[p]), leaves[p], saved[p],
            sha(",".join(map(str, ends)).encode()),
        ))
    return sorted(out, key=lambda r: r[:2])
