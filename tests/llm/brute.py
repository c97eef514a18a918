"""Plain versions of what the operators compute, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

from featuremart.llm import pieces as P
from featuremart.llm.queries import DOMAINS, MIX_WEIGHTS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def remainder(i, n):
    return zlib.crc32(("" if i is None else str(i)).encode()) % n


def quality_counts(text):
    t = text or ""
    w = words(t)
    lines = [x for x in t.split("\n") if words(x)]
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    often, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if often[x] > 1:
            covered.update(range(i, i + 8))
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def secrets(text):
    t, out = text or "", []
    out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(out))


def base_scores(rows):
    """doc_id -> (n_tokens, n_known, train_tokens, base)."""
    tokens = {i: [*(t or "").encode().lower().split(), b"\n"] for i, t in rows}
    c = Counter(w for i, ws in tokens.items() if remainder(i, 7) != 2 for w in ws)
    n, v = sum(c.values()), len(c)
    return {i: (len(ws), sum(w in c for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for i, ws in tokens.items()}


def shingle_set(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(rows, k, percent):
    sets = {i: shingle_set(t, k) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted((i for i in sets if sets[i]), key=lambda i: len(sets[i]))
    for p, i in enumerate(ids):
        for j in ids[p + 1 :]:
            if len(sets[j]) * percent > len(sets[i]) * 100:
                break
            common = len(sets[i] & sets[j])
            if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def without_boilerplate(rows, ratio, least, long_ratio=None, long_pages=1):
    """(host, text) rows -> texts."""
    share = lambda x: ratio if long_ratio is None or len(x) < 40 else long_ratio
    bare = lambda x: x.strip(" \t\x0b\f\r")
    pages, seen = Counter(), Counter()
    for host, t in rows:
        pages[host] += 1
        seen.update((host, x) for x in {bare(x) for x in (t or "").split("\n")} - {""})
    bad = {k for k, n in seen.items() if pages[k[0]] >= least and n > pages[k[0]] * share(k[1]) and (len(k[1]) < 40 or n >= long_pages)}
    return [t if t is None else "\n".join(x for x in t.split("\n") if (h, bare(x)) not in bad) for h, t in rows]


def fill(children, budget):
    """Water filling of ``{path: (weight, capacity)}``."""
    order = sorted(children, key=lambda p: (children[p][1] / children[p][0], children[p][1], p))
    out, left = {}, budget
    while order and children[order[0]][1] * sum(children[p][0] for p in order) <= children[order[0]][0] * left:
        p = order.pop(0)
        out[p] = children[p][1]
        left -= out[p]
    total = sum(children[p][0] for p in order)
    return out | {p: min(children[p][1], math.floor(children[p][0] * left / total)) for p in order}


def mixture(rows, share, epochs, seed):
    """(id, lang, source, tokens) rows -> {id: epochs used}; ids are unique."""
    of = lambda s: next((d for d, m in DOMAINS.items() if s in {f"src{i}" for i in m}), None)
    part = lambda v: "~" if v is None else f"={v}"
    leaves = defaultdict(list)
    for i, lang, source, n in rows:
        leaves[(part(of(source)), part(lang), part(source))].append((i, n))
    total = sum(r[3] for r in rows)
    budgets = {(): min(total * epochs, math.floor(total * share))}
    for k in (1, 2, 3):
        caps = defaultdict(int)
        for path, docs in leaves.items():
            caps[path[:k]] += sum(n for _, n in docs) * epochs
        groups = defaultdict(dict)
        for path, cap in caps.items():
            groups[path[:-1]]["|".join(path)] = (MIX_WEIGHTS.get("|".join(path), 1), cap)
        budgets = {tuple(p.split("|")): b for up, kids in groups.items() for p, b in fill(kids, budgets[up]).items()}
    out = {}
    for path, docs in leaves.items():
        have = sum(n for _, n in docs)
        whole = budgets[path] // have if have else epochs - 1
        rest, upto = budgets[path] - whole * have, 0
        for key, i, n in sorted((hashlib.md5(f"{seed}:{whole}:{i}".encode()).hexdigest(), i, n) for i, n in docs):
            upto += n
            out[i] = min(epochs, whole + (upto <= rest))
    return {i: e for i, e in out.items() if e}


def features(text):
    t = text or ""
    w, lines = words(t), [x for x in t.split("\n") if words(x)]
    n, rows = max(len(w), 1), max(len(lines), 1)
    share = lambda chars: sum(c in chars for c in t) / max(len(t), 1)
    return np.array([
        math.log1p(len(w)), sum(map(len, w)) / n, math.log1p(max(map(len, w), default=0)), len(set(w)) / n, math.log1p(len(w) / rows), (len(lines) - len(set(lines))) / rows,
        share("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), share("0123456789"), share(".,;:?"), share("!"), share("#*$%&|<>@^~_=+/\\{}[]"), share(" \t\n\x0b\f\r"),
    ])


def pieces(text, vocabulary: P.Vocabulary):
    """A plain search over all places and pieces that end there; of equal scores the earliest start."""
    if not text:
        return []
    score = {w: hit for w, hit in vocabulary.trie.items() if hit}
    t = f" {text}"
    best, back = [0], [None]
    for j in range(1, len(t) + 1):
        top = None
        for i in range(max(0, j - vocabulary.reach), j):
            hit = score.get(t[i:j])
            if hit is None and j - i == 1:
                hit = (None, vocabulary.unknown)
            if hit and (top is None or best[i] + hit[1] > top[0]):
                top = (best[i] + hit[1], i, hit[0])
        best.append(top[0])
        back.append(top[1:])
    out, j = [], len(t)
    while j:
        i, piece = back[j]
        out.append([piece] if piece is not None else [vocabulary.byte_ids[b] for b in t[i:j].encode()])
        j = i
    return [p for part in reversed(out) for p in part]
