"""Plain versions of the training-data operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


def shingles(text, k):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def components(texts: dict, k: int, percent: int) -> dict:
    sets = {i: shingles(t, k) for i, t in texts.items()}
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    holders = defaultdict(list)
    for i in sorted(sets):
        shared = Counter(j for s in sets[i] for j in holders[s])
        for j, n in shared.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
        for s in sets[i]:
            holders[s].append(i)
    return {i: (len(sets[i]), find(i)) for i in sets}


def kept_lines(texts: dict) -> dict:
    """id -> (text without lines similar to an earlier one, how many went)."""
    seen, holders, out = [], defaultdict(list), {}
    for i in sorted(texts):
        left, gone = [], 0
        for line in (texts[i].split("\n") if texts[i] is not None else []):
            s = frozenset(words(line))
            shared = Counter(m for w in s for m in holders[w])
            hit = any(5 * n >= 4 * (len(s) + len(seen[m]) - n) for m, n in shared.items())
            for w in s:
                holders[w].append(len(seen))
            seen.append(s)
            gone += hit
            if not hit:
                left.append(line)
        out[i] = (None if texts[i] is None else "\n".join(left), gone)
    return out


PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits):
    total = 0
    for i, c in enumerate(digits[::-1]):
        x = int(c) * (1 + i % 2)
        total += x if x < 10 else x - 9
    return total % 10 == 0


def personal(text):
    """Base spans as (start, kind's place, end)."""
    out = []
    for n, (kind, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), n, m.end()))
    return sorted(out)


def personal_text(spans):
    return ",".join(f"{PATTERNS[k][0]}:{s}:{e}" for s, k, e in spans)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def mix_targets(sizes: dict) -> dict:
    """source -> target: 3, 1, 2 by order, 150 %, capped at twice the size, reshared until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total = Fraction(3, 2) * sum(sizes.values())
    full: set = set()
    while True:
        rest = [s for s in order if s not in full]
        w = sum(weight[s] for s in rest)
        level = (total - sum(2 * sizes[s] for s in full)) / w if w else 0
        over = {s for s in rest if weight[s] * level > 2 * sizes[s]}
        if not over:
            return {s: float(2 * sizes[s] if s in full else weight[s] * level) for s in order}
        full |= over


def sainte_lague(weights: dict, caps: dict, seats: int) -> dict:
    got = dict.fromkeys(weights, 0)
    for _ in range(seats):
        free = [s for s in sorted(weights) if got[s] < caps[s] and weights[s] > 0]
        if not free:
            break
        got[max(free, key=lambda s: (weights[s] / (2 * got[s] + 1), [-x for x in s] if isinstance(s, tuple) else -s))] += 1
    return got
