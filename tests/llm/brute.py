"""Plain Python versions of what the operators must return, straight from their definitions."""

import hashlib
import math
import re
import zlib


def sha(s):
    return hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def pii_base(text):
    text = text or ""
    out = {"email": [], "ip": [], "card": [], "phone": []}
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out["email"].append(m.span())
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out["ip"].append(m.span())
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out["card"].append(m.span())
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out["phone"].append(m.span())
    return out


def secret_base(text):
    text = text or ""
    out = {"assign": [], "access": [], "hex": []}
    word = r"(password|passwd|secret|token|api_?key)"
    either = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
    for m in re.finditer(either + r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m[2]) >= 6:
            out["assign"].append(m.span())
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 20:
            out["access"].append(m.span())
    for m in re.finditer(r"[0-9a-f]+", text):
        if len(m[0]) >= 24:
            out["hex"].append(m.span())
    return out


def pii_digest(text):
    b = pii_base(text)
    return sha(",".join(f"{k}:{s}:{e}" for k in ("email", "ip", "card", "phone") for s, e in b[k]))


def secret_digest(text):
    b = secret_base(text)
    rows = sorted((s, i, e, k) for i, k in enumerate(("assign", "access", "hex")) for s, e in b[k])
    return sha(",".join(f"{k}:{s}:{e}" for s, _, e, k in rows))


def max_entropy(s, w=20):
    best = 0.0
    for i in range(len(s) - w + 1):
        part = s[i:i + w]
        best = max(best, -sum(part.count(c) / w * math.log2(part.count(c) / w) for c in set(part)))
    return best


def words(text):
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(text, n):
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))}


def near_components(rows, n=2, percent=80):
    """{position: smallest doc_id reachable} for (doc_id, text) rows, by comparing all pairs."""
    sets = [shingles(t, n) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    by = {}
    for i, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        common = {}
        for x in s:
            for j in by[x]:
                if j < i:
                    common[j] = common.get(j, 0) + 1
        for j, c in common.items():
            if 100 * c >= percent * (len(s) + len(sets[j]) - c):
                up[top(i)] = top(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        best[top(i)] = min(best.get(top(i), d), d)
    return [best[top(i)] for i in range(len(rows))], [len(s) for s in sets]


def edited_texts(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for i, (d, t) in enumerate(rows):
        t, nxt = t or "", rows[(i + 1) % len(rows)][1] or ""
        h = len(t) // 2
        out.append((d, t[:len(t) - h] + nxt[:h], nxt))
    return out


def crc(text):
    return zlib.crc32((text or "").encode())


def line_runs(rows, least=50):
    """Deleted line numbers of each (doc_id, text) row, by listing every run of lines with ``least`` words."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    lines = [(t or "").encode().split(b"\n") if t is not None else [] for _, t in rows]
    seen, gone = {}, [set() for _ in rows]
    spans = []
    for i in order:
        own = lines[i]
        count = [len(x.split()) for x in own]
        for s in range(len(own)):
            total = 0
            for e in range(s, len(own)):
                total += count[e]
                if total >= least:
                    spans.append((i, s, e + 1, tuple(own[s:e + 1])))
    rank = {i: k for k, i in enumerate(order)}
    for i, s, e, run in sorted(spans, key=lambda x: (rank[x[0]], x[1], x[2])):
        if run not in seen:
            seen[run] = (i, s)
        elif seen[run] != (i, s):
            f, fs = seen[run]
            gone[i] |= set(range(max(s, fs + e - s) if f == i else s, e))
    return gone


def mixture(rows, weights=(1, 2, 3), cap=3):
    """{row index: (size, source_size, target, copies)} for (doc_id, text, source) rows."""
    size = [len(words(t)) for _, t, _ in rows]
    place = [int(hashlib.md5((("" if d is None else str(d)) + ":" + (t or "")).encode()).hexdigest()[:15], 16) for d, t, _ in rows]
    sources = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(z for z, r in zip(size, rows) if r[2] == s) for s in sources}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    held = set()
    while True:
        rest = sum(total.values()) - sum(cap * total[s] for s in held)
        w = sum(weight[s] for s in sources if s not in held)
        more = {s for s in sources if s not in held and w and weight[s] * rest > cap * total[s] * w}
        if not more:
            break
        held |= more
    target = {s: float(cap * total[s]) if s in held else float(weight[s]) * float(rest) / float(w) for s in sources}
    out = {}
    for s in sources:
        full = min(int(target[s] // total[s]), cap) if total[s] else 0
        budget, taken, extra = target[s] - full * total[s], 0, set()
        cells = {}
        for i, r in enumerate(rows):
            if r[2] == s and size[i]:
                cells.setdefault(place[i], []).append(i)
        for p in sorted(cells):
            n = sum(size[i] for i in cells[p])
            if full >= cap or taken > budget:
                break
            if taken + n <= budget or taken + n - budget < budget - taken:
                extra |= set(cells[p])
            taken += n
        for i, r in enumerate(rows):
            if r[2] == s:
                out[i] = (size[i], total[s], target[s], full + (i in extra))
    return out


def _hash(value, seed=42):
    """Spark's xxhash64 of a string, or of a long."""
    import struct
    import xxhash
    return xxhash.xxh64_intdigest(value.encode() if isinstance(value, str) else struct.pack("<q", value), seed)


def sketch(text, width=5, keep_one_in=4):
    words = [h - (1 << 64) if h >> 63 else h for h in map(_hash, re.findall(r"[^ \t-\r]+", text.lower()))]
    if not words:
        return []
    hashes = set()
    for i in range(max(len(words) - width, 0) + 1):
        h = 42
        for w in words[i:i + width]:
            h = _hash(w, h)
        hashes.add(h >> 1)
    return sorted(h for h in hashes if h < (1 << 63) // keep_one_in) or [min(hashes)]


def resemblance(a, b):
    return len(set(a) & set(b)) / len(set(a) | set(b)) if a or b else 1.0


def containment(a, b, keep_one_in=4):
    kept = [x for x in a if x < (1 << 63) // keep_one_in]
    if a == b:
        return 1.0
    return 0.0 if not a else len(set(kept) & set(b)) / len(kept) if kept else None
