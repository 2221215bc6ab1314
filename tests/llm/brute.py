"""Plain versions of the operators, to hold results against on small tables."""

import hashlib
import re

import numpy as np
import xxhash


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def suffix_dedup(rows, window=100):
    """doc_id -> (n_bytes, n_removed, n_spans, sha) for rows of distinct, non-null doc_id."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - window + 1):
            piece = data[i : i + window]
            if piece in seen:
                gone[i : i + window] = b"\1" * window
            seen.add(piece)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[doc_id] = (len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), digest(kept))
    return out


def substring_dedup(rows, window=13):
    first, out = {}, {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        words = (text or "").encode().split()
        for i in range(len(words) - window + 1):
            first.setdefault(tuple(words[i : i + window]), doc_id)
    for doc_id, text in rows:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] < doc_id:
                gone[i : i + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out[doc_id] = (len(words), sum(gone), digest(kept))
    return out


def simhash(rows, shingle=4, budget=4):
    """doc_id -> (hex fingerprint, least doc_id reachable)."""
    ids, fps = [], []
    for doc_id, text in rows:
        words = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
        grams = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        ids.append(doc_id)
        fps.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    label = classes(len(fps), linked(fps, budget))
    least = {}
    for doc_id, c in zip(ids, label):
        least[c] = min(least.get(c, doc_id), doc_id)
    return {d: (f"{f:016x}", least[c]) for d, f, c in zip(ids, fps, label)}


def linked(fps, budget):
    array = np.array(fps, dtype=np.uint64)
    return [(i, int(j)) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(array ^ array[i]) <= budget) if j > i]


def classes(n, links):
    label = list(range(n))

    def root(x):
        while label[x] != x:
            label[x] = label[label[x]]
            x = label[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        label[max(a, b)] = min(a, b)
    return [root(x) for x in range(n)]
