"""Plain restatements of what the operators compute, for small tables."""

import hashlib
import re

import numpy as np
import xxhash


def _removed(symbols, window, seen):
    gone = bytearray(len(symbols))
    for i in range(len(symbols) - window + 1):
        key = symbols[i:i + window]
        if key in seen:
            gone[i:i + window] = b"\1" * window
        else:
            seen.add(key)
    return gone


def words(text):
    return tuple(re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode()))


def substring_dedup(rows, window=20):
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        own = words(text)
        gone = _removed(own, window, seen)
        kept = b" ".join(w for w, g in zip(own, gone) if not g)
        out[doc_id] = (len(own), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def byte_dedup(rows, window=100):
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        own = (text or "").encode()
        gone = _removed(own, window, seen)
        kept = bytes(b for b, g in zip(own, gone) if not g)
        runs = (b"\0" + bytes(gone)).count(b"\0\1")
        out[doc_id] = (len(own), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def simhash(text, shingle=4):
    own = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in words(text)]
    shingles = ([b" ".join(own[i:i + shingle]) for i in range(len(own) - shingle + 1)]
                if len(own) >= shingle else [b" ".join(own)] if own else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, distance=4):
    """prints: id -> fingerprint. Smallest id reachable, by comparing all pairs."""
    ids = sorted(prints)
    values = np.array([prints[i] for i in ids], np.uint64)
    parent = list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1:] ^ values[i]) <= distance) + i + 1:
            a, b = sorted((root(i), root(int(j))))
            parent[b] = a
    return {ids[i]: ids[root(i)] for i in range(len(ids))}


def top_k(rows, queries, k):
    """rows, queries: id -> vector."""
    out = []
    for q, own in queries.items():
        scores = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in rows.items() if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return out


def shingles(text, size=5):
    own = [w.lower() for w in words(text)]
    return {b" ".join(own[i:i + size]) for i in range(max(1, len(own) - size + 1))}


def kept_of_similar(rows, similarity=0.8):
    """Smallest ids of the components, by comparing all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    label = {i: i for i in sets}
    for i in sets:
        for j in sets:
            if i < j and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= similarity:
                a, b = sorted((label[i], label[j]))
                label = {k: a if v == b else v for k, v in label.items()}
    return set(label.values())


def _signed(value):
    return value - (1 << 64) if value >> 63 else value


def _chained(parts):
    """Hash of several byte strings, each seeded with the hash of those before."""
    seed = 42
    for part in parts:
        seed = xxhash.xxh64_intdigest(part, seed)
    return _signed(seed)


def order_minhash(text, gram=3, bins=32, size=2):
    """Fingerprint of occurrence-numbered k-mers: per bin the least ones, in text order, hashed."""
    own = words(text)
    grams = [own[i:i + gram] for i in range(len(own) - gram + 1)] if len(own) >= gram else [own] if own else []
    seen, kmers = {}, [[] for _ in range(bins)]
    for place, parts in enumerate(grams):
        key = _chained(parts) >> 26
        number = seen[key] = seen.get(key, -1) + 1
        if number:
            key = _chained([key.to_bytes(8, "little", signed=True), number.to_bytes(4, "little")]) >> 26
        kmers[(key >> 33) + bins // 2].append((key, place))
    out = []
    for own in kmers:
        least = sorted(sorted(own)[:size], key=lambda k: k[1])
        digest = _chained([key.to_bytes(8, "little", signed=True) for key, _ in least])
        out.append(f"{digest & (1 << 64) - 1:016x}"[8:] if least else "-" * 8)
    return "".join(out)


def order_likeness(one, other):
    pairs = [(one[i:i + 8], other[i:i + 8]) for i in range(0, len(one), 8)]
    held = [p for p in pairs if p != ("-" * 8, "-" * 8)]
    return sum(a == b for a, b in held) / len(held) if held else 1.0
