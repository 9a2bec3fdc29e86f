"""Plain versions of what the llm queries promise, for small tables."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import numpy as np


def crc(doc_id) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode())


def words(text) -> list[bytes]:
    return (text or "").encode().split()  # bytes.split() cuts at the same six ASCII characters


def lower_words(text) -> list[bytes]:
    return (text or "").encode().lower().split()


def unigram(rows) -> list[tuple]:
    """(n_tokens, n_known, train_tokens, base_score) of (doc_id, text) rows."""
    tokens = [[*lower_words(t), None] for _, t in rows]
    counts = collections.Counter(w for (d, _), ts in zip(rows, tokens) if crc(d) % 5 != 1 for w in ts)
    n, v = sum(counts.values()), len(counts)
    return [
        (len(ts), sum(counts[w] > 0 for w in ts), n, sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ts))
        for ts in tokens
    ]


def targets(sizes: dict) -> dict:
    """Sources' targets by repeated resharing."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: 3.0 * sizes[s] for s in over}


def base_spans(text) -> list[str]:
    text = text or ""
    found = []
    for m in re.finditer(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, re.I | re.A):
        if len(m[2]) >= 12:
            found.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 18:
            found.append((m.start(), 1, f"access:{m.start()}:{m.end()}"))
    for m in re.finditer("[0-9a-f]+", text):
        if len(m[0]) >= 16:
            found.append((m.start(), 2, f"hex:{m.start()}:{m.end()}"))
    return [x for _, _, x in sorted(found)]


def sha(spans: list[str]) -> str:
    return hashlib.sha256(",".join(spans).encode()).hexdigest()


def components(nodes: list, links: list[tuple]) -> dict:
    """The least node reachable from each node."""
    near = collections.defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for n in sorted(nodes):
        if n in out:
            continue
        todo = [n]
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = n
                todo += near[x]
    return out


def cosine_links(vectors: list) -> list[tuple[int, int]]:
    """Pairs of places with a cosine of 0.95 or more."""
    fit = {}
    for i, v in enumerate(vectors):
        if v and None not in v and all(math.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float64)
            fit[i] = x / np.linalg.norm(x)
    places = sorted(fit)
    return [(i, j) for i in places for j in places if i < j and len(fit[i]) == len(fit[j]) and fit[i] @ fit[j] >= 0.95]


def shingles(text, n: int) -> set:
    w = lower_words(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def similar(sets: list[set], percent: int = 80) -> list[tuple[int, int]]:
    return [
        (i, j)
        for i in range(len(sets))
        for j in range(i + 1, len(sets))
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]


def rules(text) -> tuple[int, int, int, int, int]:
    text = text or ""
    w = [x.decode() for x in words(text)]
    seen = collections.Counter(zip(w, w[1:], w[2:]))
    covered = set()
    for i in range(len(w) - 2):
        if seen[(w[i], w[i + 1], w[i + 2])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def terms(text) -> list[bytes]:
    return re.findall(rb"[0-9a-z\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


def ranked(docs, items, k=10) -> list[tuple]:
    """(item_id, rank, doc_id, score) of (doc_id, text) and (item_id, text) rows, every document scored for every item."""
    held = [(d, collections.Counter(ts), len(ts)) for d, t in docs if (ts := terms(t))]
    n_all, length = len(held), sum(n for _, _, n in held)
    df = collections.Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c, n in held:
            m = 100 - 75 + 75 * n * n_all // length
            score = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if c[t])
            if score > 0:
                found.append((-score, d is None, d or 0))
        out += [(item, i + 1, None if no else d, -s) for i, (s, no, d) in enumerate(sorted(found)[:k])]
    return out


def aligned(texts, tokenizer, pieces) -> list[tuple]:
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each text, token by token."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    found, counts = [], collections.Counter()
    for text in texts:
        want = (" " + (text or "")).encode()
        e = tokenizer.encode(" " + (text or ""), add_special_tokens=False)
        a = [(i, bytes(byte_of[c] for c in t)) for i, t in zip(e.ids, e.tokens)]
        b = [(i, bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("\u2581", " ").encode()) for i in pieces.encode(text or "") for p in [pieces.id_to_piece(i)]]
        if not text or b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            found.append(None)
            continue
        ends = [list(np.cumsum([len(x) for _, x in side])) for side in (a, b)]
        groups, links, i, j = [], [], 0, 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            x, y = ends[0].index(cut, i) + 1, ends[1].index(cut, j) + 1
            groups.append(",".join(str(t) for t, _ in a[i:x]) + "|" + ",".join(str(t) for t, _ in b[j:y]))
            links.append((a[x - 1][0], b[y - 1][0]))
            i, j = x, y
        counts.update(links)
        found.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = collections.Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [
        (0, 0, 0, 0, 0, 0, "") if f is None else (*f[:3], len(f[3]), sum(counts[x] == most[x[1]] for x in f[3]), sum(counts[x] for x in f[3]), f[4])
        for f in found
    ]
