"""Plain Python versions of the document operators, for small inputs."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np

WORD = re.compile("[^\x20\x09-\x0d]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def shingles(text, width=5):
    w = words((text or "").translate(ASCII))
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


def components(rows, percent=80, width=5):
    """{id: (set size, smallest id reachable)} for rows (id, text) with different ids."""
    sets = {i: shingles(t, width) for i, t in rows}
    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in sets.items():
        common = Counter(j for x in s for j in holders[x] if j < i)
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def remaining(texts, need):
    """For each text (bytes, removed, runs, digest of the rest) after removing what is repeated anywhere."""
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + need] for r in raws for i in range(len(r) - need + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - need + 1):
            if seen[r[i:i + need]] > 1:
                gone[i:i + need] = b"\1" * need
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(r), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(r, gone) if not g)).hexdigest()))
    return out


def check_packing(pieces, ids_of, size=4096):
    """Every id of every document in exactly one piece, sequences gapless and no longer than ``size``; returns the padding share.

    ``ids_of`` maps a document to its ids, the end id included; ``pieces`` are rows of the packing.
    """
    sequences, docs = {}, {}
    for p in pieces:
        part = ids_of[p["doc_id"]][p["start"]:p["start"] + p["length"]]
        assert p["length"] == len(part) > 0 and p["doc_tokens"] == len(ids_of[p["doc_id"]])
        assert p["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        docs.setdefault(p["doc_id"], []).append((p["start"], p["length"]))
    assert sorted(sequences) == list(range(len(sequences)))
    for runs in [*sequences.values(), *docs.values()]:
        at = 0
        for start, n in sorted(runs):
            assert start == at
            at += n
    assert all(sum(n for _, n in runs) <= size for runs in sequences.values())
    assert {d: sum(n for _, n in runs) for d, runs in docs.items()} == {d: len(i) for d, i in ids_of.items()}
    return 1 - sum(len(i) for i in ids_of.values()) / (size * max(len(sequences), 1))


def kept(text):
    """The verdict of the quality rules."""
    t, w = text or "", words(text)
    n, lines = len(w), [x for x in (text or "").split("\n") if WORD.search(x)]
    runs = Counter(tuple(w[i:i + 8]) for i in range(n - 7))
    covered = {p for i in range(n - 7) if runs[tuple(w[i:i + 8])] > 1 for p in range(i, i + 8)}
    symbols, marks = sum(t.count(c) for c in "#*$%&|<>"), sum(t.count(c) for c in "!?")
    stutters, chars, again = sum(a == b for a, b in zip(w, w[1:])), sum(map(len, w)), len(lines) - len(set(lines))
    return not (
        n < 20 or 100 * len(covered) > 30 * n or 100 * symbols > 20 * n or again > 3 and 100 * again > 30 * len(lines)
        or 100 * stutters > 20 * n or 100 * marks > 50 * n or chars > 15 * n or chars < 2 * n)


def mixed(rows, weights=(3, 1, 2), share=1.5, most=2, seed="mix"):
    """{position of the row: copies taken} for rows (id, source, text)."""
    size = [len(words(t)) for _, _, t in rows]
    total = Counter()
    for (_, source, _), n in zip(rows, size):
        total[source] += n
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, full = share * sum(size), set()
    while True:
        rest = sum(weight[s] for s in order if s not in full)
        level = (budget - sum(most * total[s] for s in full)) / rest if rest else 0.0
        more = {s for s in order if s not in full and most * total[s] <= level * weight[s]}
        if not more:
            break
        full |= more
    target = {s: float(most * total[s]) if s in full else level * weight[s] for s in order}
    queue = {}
    for k, (i, source, text) in enumerate(rows):
        name = str(i) if i is not None else hashlib.md5(text.encode()).hexdigest() if text is not None else ""
        queue.setdefault(source, []).append((hashlib.md5(f"{seed}:{name}".encode()).hexdigest(), i is not None, i or 0, size[k], k))
    copies = []
    for source, q in queue.items():
        cum = 0
        for *_, n, k in sorted(q):
            cum += n
            if n and target[source] > 0:
                copies += [((cum + e * total[source]) / target[source], "" if source is None else "=" + source, e, n, k) for e in range(most)]
    out, used = Counter(), 0
    for *_, n, k in sorted(copies):
        if used + n > budget:
            break
        used += n
        out[k] += 1
    return out


def near(word, other):
    """Whether one inserted, deleted or replaced code point turns one word into the other."""
    if abs(len(word) - len(other)) > 1 or word == other:
        return False
    if len(word) == len(other):
        return sum(a != b for a, b in zip(word, other)) == 1
    short, long = sorted((word, other), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def variants(rows, divisor=0, least_length=6, least_count=5, ratio=5):
    """{word: (form, root, n, n_near, form_n)} for rows (id, text), comparing every word with every other."""
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = run.translate(ASCII)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if divisor and h % divisor == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words_ = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}
    forms, out = {}, {}
    for w, n in words_.items():
        others = [o for o in words_ if near(w, o)]
        best = min(others, key=lambda o: (-words_[o], o), default=None)
        forms[w] = (best if best is not None and words_[best] >= ratio * n else None, len(others))
    for w, n in words_.items():
        root = w
        while forms[root][0] is not None:
            root = forms[root][0]
        form = forms[w][0]
        out[w] = (form, root, n, forms[w][1], words_.get(form))
    return out


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def manifest(rows, claim):
    """Sorted (id, leaf, subroot, root, digest of siblings, folded root) for rows (id, source, lang, n_chars, text); ``claim`` changes a row."""
    def leaf(r):
        return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in r])

    langs = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))):
        langs.setdefault(r[2], []).append(r)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: _levels([leaf(r) for r in langs[x]]) for x in order}
    top = _levels([trees[x][-1][0] for x in order])
    out = []
    for a, x in enumerate(order):
        for i, r in enumerate(langs[x]):
            siblings, folded = [], leaf(claim(r))
            for tree, at in ((trees[x], i), (top, a)):
                for level in tree[:-1]:
                    pair = level[at - at % 2:at - at % 2 + 2]
                    siblings += [d for k, d in enumerate(pair) if k != at % 2]
                    pair[at % 2] = folded
                    folded = digest(*pair)
                    at //= 2
            out.append((r[0], leaf(r), trees[x][-1][0], top[-1][0], digest(*siblings), folded))
    return sorted(out, key=repr)


def slot_owners(shards, size):
    """The shard of every slot: the shards, in the order of their names, claim in turn the first free slot of their lists of preferences."""
    number = lambda name, salt: int(hashlib.md5(f"{salt}:{name}".encode()).hexdigest()[:16], 16)
    lists = {}
    for name in shards:
        offset, skip = number(name, "offset") % size, number(name, "skip") % (size - 1) + 1
        lists[name] = [(offset + k * skip) % size for k in range(size)]
        assert sorted(lists[name]) == list(range(size))
    owner = {}
    while len(owner) < size:
        for name in sorted(shards):
            free = next((slot for slot in lists[name] if slot not in owner), None)
            if free is not None:
                owner[free] = name
    return owner


def discriminant(x, labels, points, shrinkage):
    """Probability of class 1 at the points: two Gaussians with covariances drawn towards the variances of all rows, by the textbook formula."""
    x, labels, points = np.array(x, float), np.array(labels), np.array(points, float)
    variance = x.var(axis=0)
    scale = np.sqrt(np.where(variance > 1e-12, variance, 1.0))
    z, at = (x - x.mean(axis=0)) / scale, (points - x.mean(axis=0)) / scale
    logs = []
    for c in (0, 1):
        own = z[labels == c]
        cov = (1 - shrinkage) * np.cov(own.T, bias=True) + shrinkage * np.eye(x.shape[1])
        away = at - own.mean(axis=0)
        logs.append(np.log(len(own) / len(z)) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,ij->i", away, np.linalg.solve(cov, away.T).T))
    return 1 / (1 + np.exp(-np.clip(logs[1] - logs[0], -40, 40)))
