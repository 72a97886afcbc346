"""Plain versions of the operators, for small inputs only."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

SPACE = " \t\n\x0b\x0c\r"


def sha(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def targets(sizes: dict, weights=(5, 2, 1), most=3):
    """Target per source by sharing and resharing; sources in code point order, null last."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        open_weight = sum(weight[s] for s in order if s not in capped)
        share = {s: Fraction(left * weight[s], open_weight) if s not in capped else Fraction(most * sizes[s]) for s in order}
        above = {s for s in order if s not in capped and share[s] > most * sizes[s]}
        if not above:
            return {s: float(v) for s, v in share.items()}
        capped |= above
        if capped == set(order):
            return {s: float(most * sizes[s]) for s in order}


def without_lines(texts, least=10):
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))
    seen = Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")} if k)
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if seen[key(x)] < least]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def shingles(text, n=5):
    w = words(text)
    return frozenset(tuple(w[i: i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def near_classes(rows, threshold=0.8):
    """{id: (class id, links, copies)} of (id, text) rows with distinct ids."""
    sets = defaultdict(list)
    for i, t in rows:
        sets[shingles(t)].append(i)
    keys = [k for k in sets if k]
    root, links = list(range(len(keys))), Counter()

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for a in range(len(keys)):
        for b in range(a):
            both = len(keys[a] & keys[b])
            if both and both >= threshold * (len(keys[a]) + len(keys[b]) - both) - 1e-9:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    least = {}
    for a, k in enumerate(keys):
        least[find(a)] = min([*sets[k], *([least[find(a)]] if find(a) in least else [])])
    out = {i: (least[find(a)], links[a], len(sets[k])) for a, k in enumerate(keys) for i in sets[k]}
    return out | {i: (i, 0, 1) for i in sets.get(frozenset(), [])}


def without_repeats(texts, length):
    """(bytes, removed, spans, what is left) per text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i: i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i: i + length]] > 1:
                gone[i: i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(d), sum(gone), spans, bytes(b for b, g in zip(d, gone, strict=True) if not g)))
    return out


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def only_digits(text):
    return re.sub("[^0-9]", "", text)


def personal(text):
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(p) <= 255 for p in v.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda v: 16 <= len(only_digits(v)) <= 19 and luhn(only_digits(v))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 8 <= len(only_digits(v)) <= 15)]
    return [(k, m.start(), m.end()) for k, p, good in rules for m in re.finditer(p, text or "") if good(m.group())]


def secrets(text):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found = [("assign", *m.span()) for m in assign.finditer(text or "") if len(m.group(2)) >= 6]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if m.end() - m.start() >= 20]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text or "") if m.end() - m.start() >= 24]
    return sorted(found, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def lines_jaccard(a, b):
    a, b = ({x for x in t.split("\n") if x} for t in (a, b))
    return len(a & b) / len(a | b) if a | b else 1.0
