"""Plain-Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import defaultdict

ASSIGN = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def secrets(text: str | None) -> tuple:
    text = text or ""
    a = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    b = [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    c = [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    kinds = ["assign", "access", "hex"]
    spans = sorted(a + b + c, key=lambda s: (s[1], kinds.index(s[0])))
    return len(a), len(b), len(c), sha(",".join(f"{k}:{s}:{e}" for k, s, e in spans))


def chat(rows: list[tuple]) -> dict:
    """rows: conv_id, turn, role, text."""
    convs = defaultdict(list)
    for c, t, r, x in rows:
        convs[c].append(((t is not None, t or 0), r or "", x or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in turns)), len(loss), sha(loss))
    return out


def n_words(text: str | None) -> int:
    return len(WORD.findall(text or ""))


def targets(sizes: dict) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    budget, capped = float(sum(sizes.values())), {}
    while True:
        left = budget - sum(capped.values())
        open_ = [s for s in order if s not in capped]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: 3.0 * sizes[s] for s in over}


def mix(rows: list[tuple]) -> dict:
    """Passes by id, from (id, source, text): whole documents in order of virtual finish time until the budget ends."""
    by, sizes = defaultdict(list), defaultdict(int)
    for i, s, text in rows:
        n = n_words(text)
        sizes[s] += n
        by[s].append((hashlib.md5(f"{i}#{n}".encode()).hexdigest(), n, i))
    weight = {s: k % 3 + 1 for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    queue = []
    for s, docs in by.items():
        upto = 0
        for key, n, i in sorted(docs):
            upto += n
            queue += [((sizes[s] * r + upto) / weight[s], key, n, i) for r in range(3) if n]
    passes, left = {i: 0 for i, _, _ in rows}, sum(sizes.values())
    for _, _, n, i in sorted(queue):
        left -= n
        if left < 0:
            break
        passes[i] += 1
    return passes


def crc(text: str | None) -> int:
    return zlib.crc32((text or "").encode())


def shingle_set(text: str | None, size: int) -> frozenset:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def components(nodes, links) -> dict:
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def jaccard(docs: list[tuple], size: int, percent: int) -> dict:
    """docs: doc_id, text."""
    sets = {i: shingle_set(t, size) for i, t in docs}
    by = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            by[x].append(i)
    same = defaultdict(int)
    for ids in by.values():
        for k, a in enumerate(ids):
            for b in ids[k + 1 :]:
                same[a, b] += 1
    links = [(a, b) for (a, b), n in same.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]
    c = components(sets, links)
    return {i: (len(sets[i]), c[i]) for i in sets}


def suffix_dedup(docs: list[tuple], width: int) -> dict:
    """docs: doc_id, text; ids unique."""
    count = defaultdict(int)
    raws = {i: (t or "").encode() for i, t in docs}
    for r in raws.values():
        for k in range(len(r) - width + 1):
            count[r[k : k + width]] += 1
    out = {}
    for i, r in raws.items():
        gone = bytearray(len(r))
        for k in range(len(r) - width + 1):
            if count[r[k : k + width]] > 1:
                gone[k : k + width] = b"\1" * width
        kept = bytes(c for c, g in zip(r, gone, strict=True) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def integers(v: list, scale: int) -> list[int]:
    most = int(math.sqrt(2.0**61 / max(1, len(v))) / 2)
    return [max(-most, min(most, math.floor(float(scale) * x))) if abs(x) < 1e200 else int(math.copysign(most, x)) for x in v]


def usable(v) -> bool:
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def closest(x: list[int], centers: list[list[int]]) -> tuple[int, int]:
    d, k = min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), k) for k, c in enumerate(centers))
    return k, d


def moved(xs: list[list[int]], centers: list[list[int]]) -> list[list[int]]:
    by = defaultdict(list)
    for x in xs:
        by[closest(x, centers)[0]].append(x)
    return [[sum(c) // len(by[k]) for c in zip(*by[k], strict=True)] if by[k] else old for k, old in enumerate(centers)]


def vector_codes(rows: list[tuple], parts: int = 8, entries: int = 16, rounds: int = 6) -> list[tuple]:
    """rows: vec_id, vector, label; vectors of one length, a multiple of the parts."""
    kept = sorted(((i is None, i or 0, integers(v, 4096)), i, label) for i, v, label in rows if usable(v))
    errors, codes, books = [0] * len(kept), [""] * len(kept), []
    for p in range(parts):
        w = len(kept[0][0][2]) // parts
        xs = [k[2][p * w : p * w + w] for k, _, _ in kept]
        book = [list(x) for x in xs[:entries]]
        for _ in range(rounds):
            book = moved(xs, book)
        for n, x in enumerate(xs):
            k, d = closest(x, book)
            codes[n] += f"{k:02x}"
            errors[n] += d
        books += [v for c in book for v in c]
    by = defaultdict(int)
    for e, (_, _, label) in zip(errors, kept, strict=True):
        by[label] += e
    digest = sha(",".join(map(str, books)))
    return [(i, c, e, by[label], digest) for (_, i, label), c, e in zip(kept, codes, errors, strict=True)]


def centroid_clusters(rows: list[tuple], k: int = 16, rounds: int = 3, length: int = 64) -> list[tuple]:
    """rows: vec_id, vector."""
    kept = sorted(((i is None, sha(f"1:{i}"), integers(v, 64)), i) for i, v in rows if usable(v) and len(v) == length)
    xs = [key[2] for key, _ in kept]
    centers = xs[:k]
    for _ in range(rounds):
        centers = moved(xs, centers)
    found = [closest(x, centers) for x in xs]
    by = defaultdict(int)
    for c, d in found:
        by[c] += d
    return [(i, c, d, by[c], sum(by.values()), sha(",".join(map(str, centers[c])))) for (_, i), (c, d) in zip(kept, found, strict=True)]


def personal(text: str | None) -> tuple:
    """The base spans by their patterns, and their digest."""
    text = text or ""
    digits = lambda s: [int(c) for c in s if c in "0123456789"]

    def card(s):
        d = digits(s)[::-1]
        return 14 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0

    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", card),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(digits(s)) <= 15),
    }
    spans = [(m.start(), n, k, m.end()) for n, (k, (p, good)) in enumerate(kinds.items()) for m in re.finditer(p, text) if good(m[0])]
    written = [f"{k}:{s}:{e}" for s, _, k, e in sorted(spans)]
    return (*(sum(n == i for _, n, _, _ in spans) for i in range(4)), sha(",".join(written)), written)
