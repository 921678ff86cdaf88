"""Plain-Python versions of the operators, for small tables."""

import math
import re
from collections import Counter, defaultdict

import xxhash

MASK = (1 << 64) - 1


def jump_hash(key, shards):
    key &= MASK
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) & MASK
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def fingerprint(text, k=3):
    words = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    k = min(k, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, radius=2):
    """Class number of each fingerprint by all pairs of the different ones."""
    names = sorted(set(prints))
    root = {p: p for p in names}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(names):
        for b in names[:i]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    return [find(p) for p in prints]


def components(rows, radius=2):
    """{position: (fingerprint, smallest id of its class)} of (id, text) rows."""
    prints = [fingerprint(t) for _, t in rows]
    classes = groups(prints, radius)
    least = {}
    for (i, _), c in zip(rows, classes):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    return [(i, f"{p:016x}", least.get(c)) for (i, _), p, c in zip(rows, prints, classes)], classes


def words(text):
    return re.sub(r"[!-/:-@\[-`{-~]", " ", (text or "").translate(
        {c: c + 32 for c in range(65, 91)})).encode().split()


def leaks(text, items, window=13, mismatches=2, shortest=5):
    """Ids of the items that a text leaks, by every aligned window."""
    doc, out = words(text), set()
    for item, t in items:
        w = words(t)
        if len(w) < shortest:
            continue
        size = min(window, len(w))
        need = size - (mismatches if len(w) >= window else 0)
        places, diagonals = defaultdict(list), defaultdict(list)
        for j, x in enumerate(w):
            places[x].append(j)
        for i, x in enumerate(doc):
            for j in places.get(x, ()):
                diagonals[i - j].append(i)
        for d, hits in diagonals.items():
            fits = min(len(doc), d + len(w)) - max(0, d) >= size
            if fits and any(hits[k + need - 1] - hits[k] < size for k in range(len(hits) - need + 1)):
                out.add(item)
    return out


def masked_tokens(line):
    return [" " if re.search("[0-9]", x) else x for x in re.split("[ \t\r]+", line.strip(" \t\r"))]


def unlike(ends_of_texts):
    """How many signatures are no variant of a more frequent one."""
    held = Counter(ends_of_texts)

    def variant(s):
        for i in range(3):
            same = [n for o, n in held.items() if all(o[j] == s[j] for j in range(3) if j != i)]
            if held[s] < max(same) and 2 * max(same) > sum(same):
                return True
        return False

    return sum(not variant(s) for s in held)


def recurring(texts, min_docs, long_docs=5, depth=3, long_tokens=20, spread=0.2, signature=4):
    """{(text, line number)} of the lines that belong to a recurring template."""
    leaves = defaultdict(list)
    for t in dict.fromkeys(t for t in texts if t is not None):
        all_lines = t.split("\n")
        ends = tuple(tuple(masked_tokens(all_lines[i])[:signature]) for i in (0, (len(all_lines) - 1) // 2, -1))
        for n, line in enumerate(all_lines):
            masked = masked_tokens(line)
            if masked != [""]:
                leaves[len(masked), *masked[:depth]].append((t, n, masked, ends))
    out = set()
    for (size, *_), leaf in leaves.items():
        support = long_docs if size >= long_tokens else min_docs
        seen = Counter((i, x) for _, _, masked, _ in leaf for i, x in enumerate(masked) if x != " ")
        templates = defaultdict(list)
        for t, n, masked, ends in leaf:
            fixed = tuple((i, x) for i, x in enumerate(masked) if seen[i, x] >= support)
            words = sum(x != " " for x in masked)
            if len(fixed) >= min(2, size) and 2 * len(fixed) >= size and (fixed[-1][0] >= depth or len(fixed) == words):
                templates[fixed].append((t, n, ends))
        for rows in templates.values():
            held = {t: e for t, _, e in rows}
            most = max(len({e[i] for e in held.values()}) for i in range(3))
            if len(held) >= support and most >= support and (
                    most >= spread * len(held) or unlike(held.values()) >= support):
                out |= {(t, n) for t, n, _ in rows}
    return out


def without(text, gone):
    """(remaining text, lines, dropped)."""
    if text is None:
        return None, 0, 0
    lines = text.split("\n")
    drop = [n for n in range(len(lines)) if (text, n) in gone]
    return (text if not drop else "\n".join(x for n, x in enumerate(lines) if n not in drop)), len(lines), len(drop)


def top_k(rows, k, scale, is_query):
    """(query_id, rank, vec_id, score) by all products."""
    ok = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if is_query(q):
            found = sorted((-max(-2**63, min(2**63 - 1, sum(x * y for x, y in zip(a, b)))), i)
                           for i, b in ok if i != q and len(a) == len(b))[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(found, 1)]
    return out
