"""Plain Python versions of the operators' contracts, for small tables."""

import hashlib
import re

import xxhash

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def alnum(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))


def quality(t):
    w = words(t)
    lines = [x for x in (t or "").split("\n") if words(x)]
    tri = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    again = {k for k in tri if tri.count(k) > 1}
    rep = len({i + o for i, k in enumerate(tri) if k in again for o in range(3)})
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), rep, len(w) < 50 or 100 * rep > 50 * len(w))


def simhash(t, size=3):
    w = words((t or "").translate(LOW))
    sh = [" ".join(w[i:i + size]) for i in range(len(w) - size + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << j for j in range(64) if 2 * sum(x >> j & 1 for x in h) > len(h))


def groups(prints, bits=2):
    """Root place of each fingerprint's component."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def repeats(texts, size=35):
    """Per text: words, and which of them lie in a window that starts anywhere else."""
    count, all_words = {}, [words(t) for t in texts]
    for w in all_words:
        for i in range(len(w) - size + 1):
            k = tuple(w[i:i + size])
            count[k] = count.get(k, 0) + 1
    out = []
    for w in all_words:
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if count[tuple(w[i:i + size])] > 1:
                gone[i:i + size] = [True] * size
        out.append((w, gone))
    return out


def contamination(t, items, size=10):
    """(words, hit words, item ids) of a text against (item_id, text) rows."""
    w = alnum(t)
    hit, found = [False] * len(w), set()
    for item, text in items:
        b = alnum(text)
        for j in range(max(len(b) - size, 0) + 1 if b else 0):
            k = b[j:j + size]
            for i in range(len(w) - len(k) + 1):
                if w[i:i + len(k)] == k:
                    hit[i:i + len(k)] = [True] * len(k)
                    found.add(item)
    found = sorted(str(x) for x in found if x is not None)
    return len(w), sum(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest()


def runs(w, least=6, exponent=4):
    """(start, length, period) of the runs of a word list, by start and period."""
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j + q - i
            if n >= max(2 * q, least, exponent * q) and not any(q % p == 0 and all(w[x] == w[x + p] for x in range(i, i + n - p)) for p in range(1, q)):
                out.append((i, n, q))
            i = j + 1
    return sorted(out, key=lambda x: (x[0], x[2]))


def aligned(texts, encode_a, bytes_a, encode_b, bytes_b):
    """Per text (n_a, n_b, n_groups, n_links, n_best, count_sum, groups) from two tokenizers' calls and the bytes of their ids."""
    found, count = [], {}
    for t in texts:
        a, b = (encode_a(" " + t), encode_b(t)) if t else ([], [])
        joined = b"".join(map(bytes_a, a))
        if not t or joined != (" " + t).encode() or b"".join(map(bytes_b, b)) != joined:
            found.append(None)
            continue
        spans = []
        for ids, of in ((a, bytes_a), (b, bytes_b)):
            at, own = 0, []
            for i in ids:
                own.append((at, at + len(of(i)), i))
                at = own[-1][1]
            spans.append(own)
        links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1]]
        for k in links:
            count[k] = count.get(k, 0) + 1
        ends, low, groups = sorted({x[1] for x in spans[0]} & {y[1] for y in spans[1]}), 0, []
        for e in ends:
            groups.append("|".join(",".join(str(x[2]) for x in own if low <= x[0] and x[1] <= e) for own in spans))
            low = e
        found.append((len(a), len(b), len(ends), links, ";".join(groups)))
    best = {}
    for (_, y), c in count.items():
        best[y] = max(best.get(y, 0), c)
    return [(0, 0, 0, 0, 0, 0, "") if f is None else (*f[:3], len(f[3]), sum(count[k] == best[k[1]] for k in f[3]), sum(count[k] for k in f[3]), f[4]) for f in found]
