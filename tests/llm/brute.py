"""Plain Python versions of what the operators return, for small tables (lists of tuples)."""

import hashlib
import math
import re
import zlib
from fractions import Fraction

import xxhash

sha = lambda b: hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()
ascii_lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def top_k(vectors, k=5, step=50):
    ok = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in vectors
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in {i: min(v for j, v in ok if j == i) for i, _ in ok if i % step == 0}.items():
        scores = sorted(((-sum(x * y for x, y in zip(a, b)), j) for j, b in ok if j != q))
        out |= {(q, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])}
    return out


def _luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


PII = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
       ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
       ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and _luhn(d)),
       ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15))
SECRETS = (("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8),
           ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16), ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 32))


def base_spans(text, rules, whole=True):
    found = [(m.start(), r, m.end(), kind) for r, (kind, p, ok) in enumerate(rules) for m in re.finditer(p, text or "", re.ASCII) if ok(m[0] if whole else m)]
    found.sort()
    return [f"{k}:{a}:{b}" for a, _, b, k in found]


def line_dedup(docs, chars=40, least=5):
    key = lambda line: ascii_lower(line.strip(" \t\n\x0b\x0c\r"))
    holders = {}
    for d, t in docs:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= chars:
                holders.setdefault(k, []).append(d)
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(h := holders.get(key(x), [])) >= least and (d is None or d != max((i for i in h if i is not None), default=None)))]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def _words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(t or ""))


def contamination(docs, items):
    windows = {}
    for i, t in items:
        w = _words(t)
        n = min(13, len(w))
        for at in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[at:at + n]), set()).add(i)
    sizes = {len(w) for w in windows}
    out = []
    for d, t in docs:
        w, hit, found = _words(t), set(), set()
        for n in sizes:
            for at in range(len(w) - n + 1):
                if (got := windows.get(tuple(w[at:at + n]))) is not None:
                    hit.update(range(at, at + n))
                    found |= {i for i in got if i is not None}
        ids = sorted(map(str, found))
        out.append((d, len(w), len(hit), len(ids), sha(",".join(ids)), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def shingles(t, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(t or ""))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def near_duplicates(docs, n=4):
    sets = [shingles(t, n) for _, t in docs]
    up = list(range(len(docs)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(both := sets[i] & sets[j]) >= 80 * (len(sets[i]) + len(sets[j]) - len(both)):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[root(i)] = min(least.get(root(i), d), d)
    return [(d, len(sets[i]), least[root(i)], d == least[root(i)]) for i, (d, _) in enumerate(docs)]


def repeats(docs, size=100):
    raw = sorted(((d, (t or "").encode()) for d, t in docs), key=lambda x: x[0])
    first = {}
    for d, b in raw:
        for i in range(len(b) - size + 1):
            first.setdefault(b[i:i + size], (d, i))
    out = []
    for d, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if first[b[i:i + size]] < (d, i):
                gone[i:i + size] = b"\1" * size
        spans = sum(1 for i, x in enumerate(gone) if x and not (i and gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, sha(bytes(c for c, x in zip(b, gone) if not x))))
    return out


def conversations(rows):
    said = {}
    for c, turn, role, text in rows + [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]:
        said.setdefault(c, []).append(((turn is not None, turn), role or "", text or ""))
    out = []
    for c, turns in said.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out.append((c, len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), sha(loss)))
    return out


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def lloyd(vectors, k, rounds, width):
    ok = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in vectors if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((sha(f"2:{i}"), v) for i, v in ok if i is not None)
    centres = [v for _, v in named[:k]]
    near = lambda v: min((sum((x - y) ** 2 for x, y in zip(v, c)), j) for j, c in enumerate(centres))
    for _ in range(rounds if centres else 0):
        at = [near(v)[1] for _, v in ok]
        for j in range(len(centres)):
            mine = [v for (_, v), a in zip(ok, at) if a == j]
            if mine:
                centres[j] = [sum(x) // len(mine) for x in zip(*mine)]
    found = [(i, *near(v)) for i, v in ok] if centres else []
    inertia = {j: sum(d for _, d, a in found if a == j) for j in range(len(centres))}
    return [(i, j, d, inertia[j], sum(inertia.values()), sha(",".join(map(str, centres[j])))) for i, d, j in found]


def words_of(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def runs(w):
    """(start, length, period) of every stretch with smallest period q and at least max(6, 4q) words."""
    out, n = [], len(w)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            stretch = w[i:i + length]
            if length >= max(6, 4 * q) and not any(all(stretch[x] == stretch[x + p] for x in range(length - p)) for p in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic(docs, plant=True):
    out = []
    for d, t in docs:
        w = words_of(t)
        h = zlib.crc32(str(d).encode()) if d is not None else 1
        if plant and h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
        found = runs(w)
        gone = {i for s, length, q in found for i in range(s + q, s + length)}
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else None
        out.append((d, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha("".join(f"{s},{x},{q}\n" for s, x, q in found)),
                    sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def simhash(docs, size=4, errors=4):
    prints = []
    for _, t in docs:
        w = words_of(ascii_lower(t or ""))
        parts = [" ".join(w[i:i + size]) for i in range(len(w) - size + 1)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in parts]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    up = list(range(len(docs)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if docs[i][0] is not None and docs[j][0] is not None and (prints[i] ^ prints[j]).bit_count() <= errors:
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [(d, f"{prints[i]:016x}", least.get(root(i)) if d is not None else None) for i, (d, _) in enumerate(docs)]
