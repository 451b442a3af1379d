"""Plain versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter

SF_SMALL, SF_MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def shingles(text, n):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) < n:
        return {tuple(w)} if w else set()
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}


def near(rows, n, percent):
    """{id: (set size, component)} and the linked pairs; ids are distinct."""
    sets = {i: shingles(t, n) for i, t in rows}
    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    pairs = set()
    for i, s in sets.items():
        for j, k in Counter(j for x in s for j in holders[x] if j > i).items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                pairs.add((i, j))
                a, b = top(i), top(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), top(i)) for i in sets}, pairs


def cut_lines(rows, min_chars=20, min_docs=3):
    """{id: (n_lines, n_dropped, text)}; ids are distinct."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(i)
    keeper = {k: max(h) for k, h in holders.items() if len(h) >= min_docs}
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if keeper.get(key(x), i) == i]
        out[i] = (len(lines), len(lines) - len(left), "\n".join(left))
    return out


def repeated_bytes(rows, length):
    """[(id, bytes, removed, spans, kept)] by looking at every string."""
    bodies = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[k : k + length] for _, b in bodies for k in range(len(b) - length + 1))
    out = []
    for i, b in bodies:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def smith_waterman(item, text, match=2, mismatch=-1, gap=-1):
    best, row = 0, [0] * (len(text) + 1)
    for w in item:
        new = [0]
        for j, x in enumerate(text, 1):
            new.append(max(0, row[j - 1] + (match if w == x else mismatch), row[j] + gap, new[j - 1] + gap))
        row = new
        best = max(best, max(row))
    return best


def alnum_words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").translate(LOWER))


def maglev(names, slots, start, step, turns):
    at, owner, free = list(start), [None] * slots, slots
    while free:
        for k, n in enumerate(turns):
            for _ in range(n):
                if not free:
                    break
                while owner[at[k]] is not None:
                    at[k] = (at[k] + step[k]) % slots
                owner[at[k]] = names[k]
                free -= 1
    return owner


def quality(text, stop, rules):
    """The counts, base_failed and kept."""
    t = text or ""
    w = WORD.findall(t)
    windows = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    hit = set()
    for k in range(len(w) - 4):
        if windows[tuple(w[k : k + 5])] > 1:
            hit.update(range(k, k + 5))
    lines = [x for x in t.split("\n") if WORD.search(x)]
    m = {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in t), "n_stop_words": sum(x.lower() in stop for x in w),
        "n_line_chars": sum(map(len, lines)), "n_dup_line_chars": sum(map(len, lines)) - sum(map(len, set(lines))), "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_unfinished_lines": sum(x.rstrip(" ").endswith(("...", "…")) for x in lines), "n_repeat_words": len(hit),
    }
    base = len(w) < 10 or 100 * len(hit) > 20 * len(w)
    good = all(len(w) < r.least_words or ((r.low is None or 100 * m[r.part] >= r.low * m[r.whole]) and (r.high is None or 100 * m[r.part] <= r.high * m[r.whole])) for r in rules)
    return m, base, not base and good


def luhn(digits):
    return sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(digits))) % 10 == 0


def personal(text):
    """Base spans (kind, start, end), by the patterns as they are stated."""
    t, out = text or "", []
    out += [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m.group().split("."))]
    for kind, pattern, low, high in (("card", r"[0-9]([\x20-]?[0-9])+", 16, 19), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 8, 15)):
        for m in re.finditer(pattern, t):
            digits = re.sub(r"[^0-9]", "", m.group())
            if low <= len(digits) <= high and (kind == "phone" or luhn(digits)):
                out.append((kind, *m.span()))
    return out


def merkle(rows, tampered):
    """rows (doc_id, source, lang, n_chars, text) -> sorted (doc_id, leaf, subroot, root, proof, folded root)."""

    def leaf(values):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values).encode())

    def tree(digests):
        """Levels of digests, the first the given ones, the last the root alone."""
        levels = [digests]
        while len(levels[-1]) > 1:
            d = levels[-1]
            levels.append([sha("".join(d[k : k + 8]).encode()) for k in range(0, len(d), 8)])
        return levels

    def siblings(levels, k):
        out = []
        for d in levels[:-1]:
            run = d[k // 8 * 8 : k // 8 * 8 + 8]
            out.append((run[: k % 8], run[k % 8 + 1 :]))
            k //= 8
        return out

    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = tree([leaf(r) for r in groups[g]])
    top = tree([trees[g][-1][0] for g in names])
    out = []
    for place, g in enumerate(names):
        for k, r in enumerate(groups[g]):
            path = siblings(trees[g], k) + siblings(top, place)
            now = leaf([*r[:4], r[4] and r[4].translate(LOWER)]) if tampered(r[0]) else leaf(r)
            for before, after in path:
                now = sha("".join([*before, now, *after]).encode())
            proof = sha("".join(x for before, after in path for x in (*before, *after)).encode())
            out.append((r[0], leaf(r), trees[g][-1][0], top[-1][0], proof, now))
    return sorted(out, key=repr)
