"""Plain versions of the operators, for small tables: one document at a time, everything in memory."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def targets(sizes: dict, weights=(5, 2, 1), share=1.5, most=2.0) -> dict:
    """Round by round: share by weight, stop those above, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, stopped = share * sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in stopped]
        left = total - sum(stopped.values())
        out = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        above = [s for s in rest if out[s] > most * sizes[s] + 1e-9]
        if not above:
            return stopped | out
        stopped |= {s: most * sizes[s] for s in above}


def contamination(docs, items, window=13):
    held = defaultdict(set)
    for item, text in items:
        words = WORD.findall((text or "").translate(LOWER))
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            held[tuple(words[i : i + n])].add(str(item))
    lengths = sorted({len(w) for w in held})
    for doc_id, text in docs:
        words = WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                got = held.get(tuple(words[i : i + n]))
                if got:
                    hit.update(range(i, i + n))
                    found |= got
        yield doc_id, len(words), len(hit), len(found), sha(",".join(sorted(found))), len(hit) > 0 and 20 * len(hit) >= len(words)


def captures(pages):
    payload = {i: (html or "").encode() for i, html in pages}
    first = {}
    for i in sorted(payload):
        first[payload[i]] = i
    for i, p in payload.items():
        response = first[p] == i
        yield i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if response else "revisit", None if response else first[p]


def chats(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    for conv, held in turns.items():
        held.sort()
        said = "".join(t for *_, role, t in held if role == "assistant")
        yield conv, len(held), sha("".join(f"{role}\n{t}\n" for *_, role, t in held)), len(said), sha(said)


def fingerprint(text, n=3):
    words = SPACED.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] if len(words) >= n else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(docs, bits=3):
    prints = [(i, fingerprint(t)) for i, t in docs]
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= bits:
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(prints):
        least[find(k)] = min(i, least.get(find(k), i))
    return [(i, f"{fp:016x}", least[find(k)]) for k, (i, fp) in enumerate(prints)]


def repeats(docs, length=200):
    raw = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(hash(b[k : k + length]) for _, b in raw for k in range(len(b) - length + 1))
    for i, b in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[hash(b[k : k + length])] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        yield i, len(b), sum(gone), sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1])), sha(kept)


def quality(docs, line_limit, least_words=50):
    docs = [(i, t or "", host) for i, t, host in docs]
    normal = lambda line: line.strip(" \t\n\x0b\x0c\r").lower()
    lines = [[(normal(x), len(x)) for x in t.split("\n") if SPACED.search(x)] for _, t, _ in docs]
    texts = defaultdict(set)
    for (i, t, host), own in zip(docs, lines):
        for line, _ in own:
            texts[host, line].add((i, t))
    for (i, t, host), own in zip(docs, lines):
        words = SPACED.findall(t)
        windows = Counter(zip(words, words[1:], words[2:]))
        again = {k + j for k, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for j in range(3)}
        whole = [x for x in t.split("\n") if SPACED.search(x)]
        failed = len(words) < least_words or 100 * len(again) > 50 * len(words)
        lost = sum(n for x, n in own if len(texts[host, x]) > line_limit)
        yield i, len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), len(whole) - len(set(whole)), len(again), failed, not failed and not 100 * lost > 50 * len(t)


def held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == 0
