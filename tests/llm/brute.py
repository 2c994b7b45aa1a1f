"""Plain Python versions of the operators, for small inputs."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANK = " \t\n\x0b\x0c\r"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def fingerprint(text, k=4):
    w = words((text or "").translate(ASCII))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))]
    ones = Counter()
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        ones.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def components(nodes, linked):
    """Map node -> smallest reachable, over all pairs."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    nodes = sorted(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def near_duplicates(rows, k=4, radius=4):
    """(id, text) rows to {index: (fingerprint, component id)}."""
    fps = [fingerprint(t, k) for _, t in rows]
    comp = components(set(fps), lambda a, b: (a ^ b).bit_count() <= radius)
    least = {}
    for (i, _), fp in zip(rows, fps, strict=True):
        if i is not None:
            least[comp[fp]] = min(least.get(comp[fp], i), i)
    return [(i, format(fp, "016x"), least.get(comp[fp])) for (i, _), fp in zip(rows, fps, strict=True)]


def lines(rows, min_docs=10, min_chars=1):
    found = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            found[line.strip(BLANK).translate(ASCII)].add(i)
    out = []
    for i, t in rows:
        parts = (t or "").split("\n")
        kept = [x for x in parts if not (len(k := x.strip(BLANK).translate(ASCII)) >= min_chars and len(found[k]) >= min_docs)]
        out.append((i, len(parts), len(parts) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def targets(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    """{source: size} to {source: target}, resharing until none is above its cap."""
    order = sorted([s for s in sizes if s is not None]) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, free, left = {}, set(order), share * sum(sizes.values())
    while free:
        level = left / sum(w[s] for s in free)
        over = {s for s in free if level * w[s] > cap * sizes[s]}
        if not over:
            return out | {s: level * w[s] for s in free}
        for s in over:
            out[s] = float(cap * sizes[s])
            left -= out[s]
        free -= over
    return out


def taken(rows, seed=7):
    """(id, source, size) rows to {id: taken}."""
    sizes = Counter()
    for _, s, n in rows:
        sizes[s] += n
    goal, out = targets(sizes), {}
    for s, total in sizes.items():
        budget = int(np.floor(goal[s] + 0.5))
        epochs, left = divmod(budget, total) if total else (0, 0)
        key = lambda r: (hashlib.md5(f"{seed}:{r[0]}".encode()).hexdigest(), r[0])
        for i, _, n in sorted((r for r in rows if r[1] == s), key=key):
            out[i] = epochs * n + min(n, left)
            left -= min(n, left)
    return out


def nearest(rows, k=10, every=100):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    ids, x = np.array([i for i, _ in good]), np.array([v for _, v in good])
    out = {}
    for i, q in good:
        if i % every == 0:
            d = np.sqrt(((x - q) ** 2).sum(1))
            order = [j for j in np.lexsort((ids, d)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(d[j])) for j in order]
    return out


def normal_words(text):
    return [w for w in re.split(r"[^\w]+|_+", (text or "").lower()) if w]


def profile(w, k):
    return Counter(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else Counter()


def similarity(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def best_window(doc, item):
    """Highest similarity of any window of the item's size (cut at the ends), by full search."""
    d, i = normal_words(doc), normal_words(item)
    if not d or not i:
        return 0.0
    k, n = min(5, len(i)), len(i)
    mine = profile(i, k)
    known = {g for g in mine}
    if not any(tuple(d[s : s + k]) in known for s in range(len(d))):
        return 0.0
    return max(similarity(profile(d[max(0, s) : s + n], 5), mine) for s in range(1 - n, len(d)))


def maximal_conversations(rows):
    """(conv, turn, role, text) rows to {kept id: (turns, copies)}."""
    conv = defaultdict(set)
    for c, t, r, x in rows:
        conv[c].add((t is None, t or 0, r, x))
    seq = {c: tuple((r, x) for *_, r, x in sorted(v, key=lambda u: (u[0], u[1]))) for c, v in conv.items()}
    out = {}
    for c, s in seq.items():
        longer = any(len(o) > len(s) and o[: len(s)] == s for o in seq.values())
        same = [d for d, o in seq.items() if o == s]
        if not longer and c == min(same, key=lambda d: (d is None, d or 0)):
            out[c] = (len(s), len(same))
    return out


def crc32(text):
    return zlib.crc32((text or "").encode())


# conversation prefix trie --------------------------------------------------

def turn_key(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def rebuilt_conversations(rows):
    """(conv, turn, role, text) rows to {conv: [(role, text), ...]} after rebuilding."""
    conv = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            conv[c].append((t is not None, t or 0, turn_key(r or "", x or ""), r or "", x or ""))
    own = {c: [tuple(y[3:]) for y in sorted(v)] for c, v in conv.items()}
    out = {}
    for c, v in own.items():
        h = crc32(str(c)) % 4
        out[c] = own.get(c - c % 20, [])[:h] + v[h:]
    return out


def trie(conv):
    """{conv: turns} to sorted node rows, by plain recursion over prefixes."""
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, v in conv.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
            if d:
                children[tuple(v[: d - 1])].add(tuple(v[:d]))
        ends[tuple(v)].append(c)
    leaves, saved = Counter(), Counter()
    for node, m in members.items():
        own = (len(m) - 1) * len(words(node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += own
            leaves[node[:d]] += node not in children
    out = []
    for node, m in members.items():
        parent = min(members[node[:-1]]) if node else None
        sha = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        out.append((len(node), min(m), parent, len(m), len(children[node]) if node in children else 0, leaves[node], saved[node], sha))
    return out


# conversation repair -------------------------------------------------------

def damaged_conversations(rows):
    """(conv, turn, role, text) rows to {conv: rows after damage, in order}."""
    out = defaultdict(list)
    for c, t, r, x in rows:
        kind = crc32(f"{' ' if c is None else c}:{' ' if t is None else t}") % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        r = "user" if kind == 4 else r
        out[c] += [(t is not None, t or 0, turn_key(r, x), r, x)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {c: [(y[1] if y[0] else None, *y[3:]) for y in sorted(v)] for c, v in out.items()}


def faults(conv):
    seen, out = set(), []
    for _, r, x in conv:
        bare = x.rstrip(BLANK)
        out.append("blank" if not bare else "duplicate" if (r, x) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((r, x))
    return out


def cheapest_edits(initials, fault):
    """(cost, audit, repaired rows as (index or None, role or None)), by a search over whole edit lists."""
    import heapq

    done, n = set(), len(initials)
    heap = [(0, "", 0, "", ())]
    while heap:
        cost, audit, i, roles, rows = heapq.heappop(heap)
        if i == n and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, rows
        key = (i, roles if len(roles) < 2 else roles[-1] + "+")
        if (key, audit) in done or any((key, a) in done for a in ()):
            continue
        done.add((key, audit))

        def go(c, letter, j, role, row):
            new = roles + role
            if re.fullmatch("s?(ua)*u?", new):
                heapq.heappush(heap, (cost + c, audit + letter, j, new, rows + row))

        for role, name in (("u", "user"), ("a", "assistant")):
            go(5, "I", i, role, ((None, name),))
        if i < n:
            go(2, "D", i + 1, "", ())
            if fault[i] not in ("blank", "duplicate"):
                extra = 5 if fault[i] == "truncated" else 0
                go(extra, "K", i + 1, initials[i] if initials[i] in ("s", "u", "a") else "?", ((i, None),))
                for role, name in (("u", "user"), ("a", "assistant")):
                    go(1 + extra, "R", i + 1, role, ((i, name),))
    raise AssertionError


def repairs(rows):
    out = []
    for c, conv in damaged_conversations(rows).items():
        f = faults(conv)
        first = [r[:1] for _, r, _ in conv]
        turn = [t for t, _, _ in conv if t is not None]
        gaps = max(turn) - min(turn) + 1 - len(set(turn)) if turn else 0
        cost, audit, kept = cheapest_edits(first, f)
        text = "\n".join(f"{name or conv[i][1]}:{'' if i is None else conv[i][2]}" for i, name in kept)
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:]))  # noqa: B905
        out.append((c, gaps, f.count("blank"), f.count("duplicate"), f.count("truncated"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return out


# embedding near-duplicates -------------------------------------------------

def embedding_groups(rows, cosine=0.93):
    """(id, vector, label) rows to (id, links, component, kept) rows, over all pairs."""
    def ok(v, label):
        return label is not None and bool(v) and None not in v and np.isfinite(v).all() and np.any(v)

    x = [np.array(v, float) / np.max(np.abs(v)) if ok(v, label) else None for _, v, label in rows]
    near = lambda a, b: (
        x[a] is not None and x[b] is not None and rows[a][2] == rows[b][2] and len(x[a]) == len(x[b])
        and (x[a] * x[b]).sum() / (np.sqrt((x[a] ** 2).sum()) * np.sqrt((x[b] ** 2).sum())) >= cosine
    )
    links = Counter()

    def linked(a, b):
        yes = near(a, b)
        links[a] += yes
        links[b] += yes
        return yes

    comp = components(range(len(rows)), linked)
    least = {}
    for i, (vec, _, _) in enumerate(rows):
        if vec is not None:
            least[comp[i]] = min(least.get(comp[i], vec), vec)
    return [(vec, links[i], least.get(comp[i]), vec == least.get(comp[i])) for i, (vec, _, _) in enumerate(rows)]
