"""Brute-force versions of the corpus operators, over lists of (doc_id, text)."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import xxhash

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def sha(x):
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def pii_base(text):
    out = []
    for kind, pattern in (("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE)):
        for m in pattern.finditer(text or ""):
            d = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(d) <= 19 and luhn(d)):
                continue
            if kind == "phone" and not 8 <= len(d) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def line_dedup(rows, m=3):
    """{doc_id: (kept text, n_removed, n_runs)} for distinct doc_ids."""
    seen, gone = {}, defaultdict(set)
    for d, t in sorted((r for r in rows if r[1] is not None)):
        lines = t.split("\n")
        for p in range(len(lines) - m + 1):
            w = tuple(lines[p:p + m])
            if w in seen:
                gone[d].update(range(p, p + m))
            else:
                seen[w] = (d, p)
    out = {}
    for d, t in rows:
        if t is None:
            out[d] = (None, 0, 0)
        else:
            lines = t.split("\n")
            g = gone[d]
            out[d] = ("\n".join(x for i, x in enumerate(lines) if i not in g), len(g), sum(1 for i in g if i - 1 not in g))
    return out


def fingerprint(text):
    t = re.sub("[A-Z]", lambda c: c.group().lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not w:
        return 0
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps, bits=2):
    """{fingerprint: least linked fingerprint set id} by breadth-first search."""
    x = np.array(sorted(set(fps)), np.uint64)
    left = set(range(len(x)))
    out = {}
    while left:
        root = min(left)
        left.discard(root)
        stack = [root]
        while stack:
            p = stack.pop()
            out[int(x[p])] = root
            rest = np.array(sorted(left), np.int64)
            if len(rest):
                near = rest[np.bitwise_count(x[rest] ^ x[p]) <= bits]
                left.difference_update(near.tolist())
                stack.extend(near.tolist())
    return out


def substring_dedup(rows, n=100):
    """{doc_id: removed byte flags}, for distinct doc_ids."""
    seen, out = {}, {}
    for d, t in sorted(rows):
        b = (t or "").encode()
        flags = np.zeros(len(b), bool)
        for i in range(len(b) - n + 1):
            w = b[i:i + n]
            if w in seen:
                flags[i:i + n] = True
            else:
                seen[w] = (d, i)
        out[d] = flags
    return out
