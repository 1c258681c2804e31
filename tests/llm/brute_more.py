"""Plain versions of turn repair, packing and run detection, for small tables."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib

from llm.brute import SPACED, sha

PATTERN = re.compile(r"(s?(ua)+)?")


def damage(rows):
    """(conv, turn, role, text) after the query's faults."""
    spaced = lambda x: " " if x is None else x
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{spaced(conv)}:{spaced(turn)}".encode()) % 20
        role, text = spaced(role), spaced(text)
        if fault:
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            yield from [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)


def faults(rows):
    """blank, duplicate, truncated or None of each (role, text)."""
    seen = set()
    for role, text in rows:
        words = SPACED.findall(text)
        yield "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1][-1] not in ".!?" else None
        seen.add((role, text))


def cheapest(rows):
    """(cost, audit, repaired) by trying everything: row by row, all partial repairs kept per initials so far."""
    marks = list(faults(rows))
    states = {"": (0, "", [])}
    close = lambda initials: PATTERN.fullmatch(initials)

    def grown(states):
        out = dict(states)
        for _ in range(2):
            for initials, (cost, audit, said) in list(out.items()):
                for role in ("user", "assistant"):
                    new = (cost + 3, audit + "I", [*said, (role, "")])
                    at = initials + role[0]
                    if _alive(at) and (at not in out or new[:2] < out[at][:2]):
                        out[at] = new
        return out

    for (role, text), mark in zip(rows, marks):
        after = {}

        def put(at, new):
            if _alive(at) and (at not in after or new[:2] < after[at][:2]):
                after[at] = new

        for initials, (cost, audit, said) in grown(states).items():
            put(initials, (cost + 4, audit + "D", said))
            if mark not in ("blank", "duplicate"):
                more = 3 * (mark == "truncated")
                put(initials + (role[:1] or "?"), (cost + more, audit + "K", [*said, (role, text)]))
                for other in ("user", "assistant"):
                    put(initials + other[0], (cost + 3 + more, audit + "R", [*said, (other, text)]))
        states = after
    return min((v for k, v in grown(states).items() if close(k)), key=lambda v: v[:2])


def _alive(initials):
    return re.fullmatch(r"s?(ua)*u?", initials)


def repairs(rows):
    """Report rows by conversation, of rows that are damaged already."""
    rows = list(rows)
    for conv in dict.fromkeys(r[0] for r in rows):
        held = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        said = [r[2:] for r in held]
        turns = {r[1] for r in held} - {None}
        marks = list(faults(said))
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(said))
        cost, audit, repaired = cheapest(said)
        yield conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(marks.count(m) for m in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha("\n".join(f"{r}:{t}" for r, t in repaired))


def loop(doc_id, words):
    """The words after the query's repetition."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def runs(words, least=24, exponent=3):
    """Every maximal stretch with each period, smallest periods only."""
    n, found = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            a = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - a + q
            # a multiple of a smaller period covers no more than that period does
            if length >= 2 * q and not any(a >= s and a + length <= s + l and q % p == 0 for (s, l), p in found.items()):
                found[a, length] = q
    return sorted((s, l, q) for (s, l), q in found.items() if l >= max(least, exponent * q))


def run_report(doc_id, text):
    words = loop(doc_id, SPACED.findall(text or ""))
    found = sorted(runs(words), key=lambda r: (r[0], r[2]))
    gone = {k for s, l, q in found for k in range(s + q, s + l)}
    best = None
    for s, l, q in found:
        if best is None or l * best[2] > best[1] * q:
            best = (s, l, q)
    told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return doc_id, len(found), *told, sha("".join(f"{s},{l},{q}\n" for s, l, q in found)), sha(" ".join(w for k, w in enumerate(words) if k not in gone))
