"""Brute-force versions the operators are compared with: small, slow, and written apart from them."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
import xxhash

A_TO_Z = {i: i + 32 for i in range(65, 91)}


def roots(names, linked) -> dict:
    """Smallest reachable name of each name."""
    parent = {n: n for n in names}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in names}


def simhash(text, shingle=3) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(A_TO_Z))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + shingle]).encode(), 42) for i in range(max(1, len(words) - shingle + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_groups(docs: dict, bits=2) -> dict:
    """doc_id -> (fingerprint, component) over all pairs."""
    prints = {d: simhash(t) for d, t in docs.items()}
    ids = sorted(docs)
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if (prints[a] ^ prints[b]).bit_count() <= bits]
    component = roots(ids, pairs)
    return {d: (f"{prints[d]:016x}", component[d]) for d in ids}


def contamination(docs, items) -> dict:
    """doc_id -> (n_words, n_hit, n_items, sha256 of the ids, contaminated)."""
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(A_TO_Z))
    windows = defaultdict(set)
    for item, text in items:
        w = split(text)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k : k + n])].add(item)
    out = {}
    for doc, text in docs:
        w, found, hit = split(text), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    found |= windows[tuple(w[k : k + n])]
                    hit.update(range(k, k + n))
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out[doc] = (len(w), len(hit), len(found), digest, bool(hit))
    return out


def near_vectors(rows, threshold=0.98) -> dict:
    """vec_id -> (n_links, component_id, kept) over all pairs; rows are (vec_id, label, vector)."""

    def usable(label, v):
        return label is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    good = {i: (label, np.array(v, dtype=float)) for i, label, v in rows if usable(label, v)}
    ids, links = sorted(i for i, _, _ in rows), []
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if a in good and b in good and good[a][0] == good[b][0] and len(good[a][1]) == len(good[b][1]):
                x, y = good[a][1], good[b][1]
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                    links.append((a, b))
    component = roots(ids, links)
    return {i: (sum(i in p for p in links), component[i], component[i] == i) for i in ids}
