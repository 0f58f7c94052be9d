"""Conversation repair by a search over all edits, for small fixtures."""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib

SPACE = " \t\n\x0b\x0c\r"
FOLLOW = {"": "su", "s": "u", "u": "a", "a": "u"}
FULL = {"u": "user", "a": "assistant"}


def damaged(rows):
    """{conv_id: [(turn, role, text)]} of [(conv_id, turn, role, text)], in order."""
    shown = lambda x: " " if x is None else str(x)
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        kind = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        role, text = "user" if kind == 4 else shown(role), "" if kind == 1 else shown(text)
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        out[conv] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for turns in out.values():
        turns.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
    return out


def cheapest(turns, kinds):
    """(cost, edits, repaired rows): the first path out of a queue ordered by cost, then edits."""
    queue, done = [(0, "", 0, "", ())], set()
    while True:
        cost, edits, i, state, built = heapq.heappop(queue)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(turns) and state in ("", "a"):
            return cost, edits, built
        steps = [(5, "I", i, r, FULL[r] + ":") for r in FOLLOW[state] if r in FULL]
        if i < len(turns):
            _, role, text = turns[i]
            steps.append((2, "D", i + 1, state, None))
            if kinds[i] in ("clean", "truncated"):
                more = 5 * (kinds[i] == "truncated")
                if role[:1] and role[:1] in FOLLOW[state]:
                    steps.append((more, "K", i + 1, role[:1], f"{role}:{text}"))
                steps += [(1 + more, "R", i + 1, r, f"{FULL[r]}:{text}") for r in FOLLOW[state] if r in FULL]
        for price, edit, to, then, line in steps:
            heapq.heappush(queue, (cost + price, edits + edit, to, then, built if line is None else (*built, line)))


def repaired(rows):
    """{conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, sha256)}."""
    out = {}
    for conv, turns in damaged(rows).items():
        seen, kinds = set(), []
        for _, role, text in turns:
            core = text.strip(SPACE)
            kinds.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else "clean")
            seen.add((role, text))
        at = [t for t, _, _ in turns if t is not None]
        initials = [r[:1] for _, r, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, edits, built = cheapest(turns, kinds)
        out[conv] = (max(at) - min(at) + 1 - len(set(at)) if at else 0, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
                     illegal, cost, edits, hashlib.sha256("\n".join(built).encode()).hexdigest())
    return out
