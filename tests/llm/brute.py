"""Plain Python versions of the corpus operators, for small inputs."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import xxhash

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def jump(key: int, shards: int) -> int:
    here, there = -1, 0
    while there < shards:
        here = there
        key = (key * 2862933555777941757 + 1) % 2**64
        there = int((here + 1) * (2.0**31 / ((key >> 33) + 1)))
    return here


def statistics(text):
    words = SPACE.findall(text or "")
    lines = [x for x in (text or "").split("\n") if SPACE.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


class KneserNey:
    """Interpolated modified Kneser-Ney over bytes, straight from the definition."""

    def __init__(self, texts, order=5):
        self.order = order
        grams = Counter()
        for t in texts:
            padded = bytes(order - 1) + t.encode()
            grams.update(padded[i : i + order] for i in range(len(padded) - order + 1))
        self.counts = {order: grams}
        for k in range(order - 1, 0, -1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.rules, self.totals = {}, {}
        for k, c in self.counts.items():
            n = [0, *(sum(v == i for v in c.values()) for i in (1, 2, 3, 4))]
            d = []
            for i, plain in ((1, 0.5), (2, 1.0), (3, 1.5)):
                own = i - (i + 1) * n[1] / (n[1] + 2 * n[2]) * n[i + 1] / n[i] if all(n[1:]) else plain
                d.append(own if 0 < own < i else plain)
            self.rules[k] = d
            total, taken = Counter(), defaultdict(float)
            for g, v in c.items():
                total[g[:-1]] += v
                taken[g[:-1]] += d[min(v, 3) - 1]
            self.totals[k] = total, taken

    def p(self, gram):
        k = len(gram)
        if k == 0:
            return 1 / 256
        total, taken = self.totals[k]
        h = gram[:-1]
        if h not in total:
            return self.p(gram[1:])
        v = self.counts[k].get(gram, 0)
        own = (v - self.rules[k][min(v, 3) - 1]) / total[h] if v else 0.0
        return own + taken[h] / total[h] * (self.p(gram[1:]) if k > 1 else 1 / 256)

    def per_word(self, text):
        padded = bytes(self.order - 1) + text.encode()
        logs = sum(math.log(self.p(padded[i : i + self.order])) for i in range(len(padded) - self.order + 1))
        return -logs / len(SPACE.findall(text))


def quality(docs, width=5.0, least=0.3):
    """doc_id -> (base_failed, kept, log perplexity) of (doc_id, text, lang)."""
    by_lang = defaultdict(list)
    for d, text, lang in docs:
        by_lang[lang or ""].append((d, text or ""))
    out = {}
    for rows in by_lang.values():
        model = KneserNey([t for _, t in rows if t])
        found = {}
        for i, (_, t) in enumerate(rows):
            n, *_, repeated = statistics(t)
            found[i] = n, n < 10 or 100 * repeated > 20 * n, model.per_word(t) if n else None
        good = [(n, x) for n, failed, x in found.values() if not failed]
        middle = lowest_half([x for _, x in good])
        scale = lowest_half([abs(x - middle) * math.sqrt(n) for n, x in good])
        for i, (d, _) in enumerate(rows):
            n, failed, x = found[i]
            out[d] = failed, not failed and abs(x - middle) <= max(width * scale / math.sqrt(n), least), x
    return out


def lowest_half(values):
    return sorted(values)[math.ceil(len(values) / 2) - 1] if values else 0.0


def dedup_lines(docs, min_chars):
    """The texts of (order, text) without later copies of runs; rows in order."""
    place = [(d, i, x) for d, (_, t) in enumerate(docs) if t is not None for i, x in enumerate(t.split("\n"))]
    at = defaultdict(list)
    for d, i, x in place:
        at[x].append((d, i))
    lines = {d: t.split("\n") for d, (_, t) in enumerate(docs) if t is not None}
    gone = set()
    for d, i, x in place:
        for e, j in at[x]:
            if (e, j) >= (d, i):
                break
            n = 0
            while i + n < len(lines[d]) and j + n < len(lines[e]) and lines[d][i + n] == lines[e][j + n]:
                n += 1
            if sum(map(len, lines[d][i : i + n])) >= min_chars:
                gone.update((d, i + k) for k in range(n))
    return [None if t is None else "\n".join(x for i, x in enumerate(lines[d]) if (d, i) not in gone) for d, (_, t) in enumerate(docs)]


def simhash(text, size):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = SPACE.findall(lowered)
    if not words:
        return 0
    size = min(size, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + size]).encode(), 42) for i in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, near):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in near:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {n: root(n) for n in nodes}


def near_duplicates(docs, size=3, bits=2):
    """doc_id -> (fingerprint, smallest doc_id reachable) of (doc_id, text)."""
    prints = {d: simhash(t, size) for d, t in docs}
    ids = sorted(prints)
    near = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if (prints[a] ^ prints[b]).bit_count() <= bits]
    reached = components(ids, near)
    return {d: (prints[d], reached[d]) for d in ids}


def words(text):
    """Runs of letters and digits; Chinese characters, kana and Thai letters one by one."""
    alone = lambda c: "\u3040" <= c <= "\u30ff" or "\u4e00" <= c <= "\u9fff" or "\u0e00" <= c <= "\u0eff"
    return [w for run in re.findall(r"[^\W_]+", text.lower()) for w in "".join(f" {c} " if alone(c) else c for c in run).split()]


def smith_waterman(a, b, match=2, mismatch=-1, gap=-1):
    row, best = [0] * (len(a) + 1), 0
    for y in b:
        last, row = row, [0]
        for j, x in enumerate(a, 1):
            row.append(max(0, last[j - 1] + (match if x == y else mismatch), last[j] + gap, row[-1] + gap))
        best = max(best, *row)
    return best


def leaks(docs, items, threshold=0.4):
    """{(doc_id, item_id): score} by aligning every document with every item."""
    out = {}
    for d, text in docs:
        found = words(text or "")
        for i, of in items:
            item = words(of or "")
            if len(item) >= 2:
                score = smith_waterman(found, item) / (2 * len(item))
                if score >= (threshold if len(item) >= 4 else 1):
                    out[d, i] = score
    return out
