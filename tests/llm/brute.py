"""Plain Python versions of the operators' contracts, for small tables."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import tiktoken
import xxhash
from tokenizers import Tokenizer


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def in_order(rows):
    return sorted(map(tuple, rows), key=str)


class Union:
    def __init__(self, n):
        self.up = list(range(n))

    def top(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x, y):
        self.up[self.top(x)] = self.top(y)


def similar(sets, percent):
    """A union of all sets with 100 * intersection >= percent * union."""
    held, out = defaultdict(list), Union(len(sets))
    for k, s in enumerate(sets):
        for e in s:
            held[e].append(k)
    for k, s in enumerate(sets):
        for j, n in Counter(j for e in s for j in held[e] if j > k).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                out.join(j, k)
    return out


def decontamination(docs, items, size=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for i, t in items:
        w = word.findall(low(t))
        for k in range(max(1, len(w) - size + 1) if w else 0):
            windows[tuple(w[k : k + size])].add(str(i))
    out = []
    for d, t in docs:
        w, hit, found = word.findall(low(t)), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if own := windows.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    found |= own
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return in_order(out)


def bpe(docs):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = [(d, enc.encode_ordinary(t or "")) for d, t in docs]
    return in_order((d, len(x), sha(",".join(map(str, x))), sha(enc.decode_bytes(x))) for d, x in rows)


def token_files(docs):
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out, start = [], 0
    for d, t in sorted(docs, key=lambda r: r[0]):
        ids = own.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return in_order(out)


def near_duplicates(docs, size=4, percent=80):
    def shingles(t):
        w = (t or "").encode().lower().split()
        return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()

    ids = defaultdict(list)
    for d, t in docs:
        ids[shingles(t)].append(d)
    sets = [s for s in ids if s]
    union, members = similar(sets, percent), defaultdict(list)
    for k, s in enumerate(sets):
        members[union.top(k)] += ids[s]
    least = {s: min((d for d in members[union.top(k)] if d is not None), default=None) for k, s in enumerate(sets)}
    rows = [(d, shingles(t)) for d, t in docs]
    return in_order((d, len(s), least[s] if s else d, d == (least[s] if s else d)) for d, s in rows)


def top_k(rows, k=20):
    def whole(x):
        return int(Fraction(x) * 64 // 1)

    fine = [(i, [whole(x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in fine:
        if q % 20 == 0:
            scored = sorted((-min(max(sum(x * y for x, y in zip(a, b)), -(2**63)), 2**63 - 1), i) for i, b in fine if i != q and len(a) == len(b))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return in_order(out)


def repeats(docs, span=200):
    texts = [(d, (t or "").encode()) for d, t in docs]
    seen = Counter(b[k : k + span] for _, b in texts for k in range(len(b) - span + 1))
    out = []
    for d, b in texts:
        gone, end = bytearray(len(b)), 0
        for k in range(len(b) - span + 1):
            if seen[b[k : k + span]] > 1:
                for x in range(max(end, k), k + span):
                    gone[x] = 1
                end = k + span
        runs = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        out.append((d, len(b), sum(gone), runs, sha(bytes(c for c, g in zip(b, gone) if not g))))
    return in_order(out)


def secrets(docs):
    rules = (
        ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
        ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20),
        ("hex", re.compile("[0-9a-f]+"), 0, 24),
    )
    out = []
    for d, t in docs:
        found = sorted((m.start(), k, m.end()) for k, (_, rule, group, least) in enumerate(rules) for m in rule.finditer(t or "") if len(m[group]) >= least)
        counts = [sum(f[1] == k for f in found) for k in range(3)]
        out.append((d, *counts, sha(",".join(f"{rules[k][0]}:{s}:{e}" for s, k, e in found))))
    return in_order(out)


def lines(docs, size=9, percent=80):
    """(id, lines, removed, their numbers): of each component the first line by id (null first) and place stays."""
    places = defaultdict(list)
    for d, t in docs:
        for n, x in enumerate(low(t).split("\n")):
            if re.search(r"[^\x20\x09-\x0D]", x):
                places[frozenset(x[i : i + size] for i in range(max(1, len(x) - size + 1)))].append((d, n))
    sets = list(places)
    union, members, gone = similar(sets, percent), defaultdict(list), defaultdict(list)
    for k, s in enumerate(sets):
        members[union.top(k)] += places[s]
    for own in members.values():
        first = min(own, key=lambda p: (p[0] is not None, p))
        for p in own:
            if p != first:
                gone[p[0]].append(p[1])
    return in_order((d, len((t or "").split("\n")), len(gone[d]), ",".join(map(str, sorted(gone[d])))) for d, t in docs)


def licenses(docs, templates, threshold):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def bigrams(t):
        w = word.findall(low(t))
        return set(zip(w, w[1:]))

    known = [(n, b) for n, t in templates if (b := bigrams(t))]
    out = []
    for d, t in docs:
        best = (0.0, None)
        for unit in {t, *re.split("\n(?:[\x00-\x09\x0b-\x2f:-@\\[-`{-\x7f]*\n)+", t or ""), *(t or "").split("\n")} if t else ():
            if own := bigrams(unit):
                for n, b in known:
                    dice = 2 * len(own & b) / (len(own) + len(b))
                    if dice >= threshold and (-dice, n) < (-best[0], best[1] or ""):
                        best = (dice, n)
        out.append((d, best[1], best[0]))
    return in_order(out)


def phrases(rows, least=30, percent=80, first=2000, longest=4):
    """``rows``: (text, lang)."""
    counts, total = Counter(), Counter()
    for t, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(t)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            counts.update((lang or "und", tuple(w[i : i + n])) for n in range(1, longest + 1) for i in range(len(w) - n + 1))
    good = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    out = defaultdict(list)
    for (lang, w), a in good.items():
        if any(la == lang and len(v) > len(w) and 100 * b >= percent * a and any(v[i : i + len(w)] == w for i in range(len(v))) for (la, v), b in good.items()):
            continue
        score, _, l, r = min((2000000 * a // (counts[lang, w[:k]] + counts[lang, w[k:]]), k, counts[lang, w[:k]], counts[lang, w[k:]]) for k in range(1, len(w)))
        out[lang].append((-score, -a, " ".join(w).encode(), l, r))
    return in_order((lang, k + 1, p.decode(), -a, l, r, total[lang], -s) for lang, own in out.items() for k, (s, a, p, l, r) in enumerate(sorted(own)[:first]))


def merkle(rows):
    """``rows``: (doc_id, source, lang, n_chars, text)."""

    def leaf(r):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][k : k + 2])) for k in range(0, len(out[-1]), 2)])
        return out

    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for own in groups.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {g: levels([leaf(r) for r in own]) for g, own in groups.items()}
    top = levels([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for at, r in enumerate(groups[g]):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            node, siblings = leaf((*r[:3], r[3] + 1, r[4]) if tampered else r), []
            for i, tree in ((at, trees[g]), (k, top)):
                for level in tree[:-1]:
                    other = level[i ^ 1] if i ^ 1 < len(level) else ""
                    siblings.append(other)
                    node = sha(other + node if i & 1 else node + other)
                    i >>= 1
            out.append((r[0], leaf(r), trees[g][-1][0], top[-1][0], sha("".join(siblings)), node, node == top[-1][0]))
    return in_order(out)


def simhash(docs, size=4, bits=4):
    def fingerprint(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", low(t))
        h = [xxhash.xxh64_intdigest(" ".join(w[i : i + size]).encode(), 42) for i in range(max(1, len(w) - size + 1))] if w else []
        return sum((2 * sum(x >> i & 1 for x in h) > len(h)) << i for i in range(64))

    prints = [fingerprint(t) for _, t in docs]
    union = Union(len(docs))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= bits:
                union.join(i, j)
    least = {}
    for k, (d, _) in enumerate(docs):
        if d is not None:
            least[union.top(k)] = min(d, least.get(union.top(k), d))
    return in_order((d, f"{prints[k]:016x}", least.get(union.top(k))) for k, (d, _) in enumerate(docs))
