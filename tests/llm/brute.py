"""Plain-Python versions of the operators' contracts."""

from __future__ import annotations

import collections
import hashlib
import itertools
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def word_list(text):
    return WORD.findall(text or "")


def fold(text):
    return re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, k=5):
    w = word_list(fold(text))
    if len(w) < k:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def linked(a, b):
    if not a or not b:
        return False
    n = len(a & b)
    return 100 * n >= 75 * (len(a) + len(b) - n)


def components(vertices, edges):
    parent = {v: v for v in vertices}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {v: find(v) for v in vertices}


def near_duplicates(docs):
    """doc_id -> (set size, component) of ``{doc_id: text}``."""
    sets = {i: shingles(t) for i, t in docs.items()}
    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    edges = set()
    for i, s in sets.items():
        meet = {j for x in s for j in holders[x] if j < i}
        edges |= {(j, i) for j in meet if linked(s, sets[j])}
    comp = components(sets, edges)
    return {i: (len(sets[i]), comp[i]) for i in sets}


def cut_repeats(docs, window=50):
    """doc_id -> (n_words, n_removed, kept_sha256) of rows ``(doc_id, text)``."""
    first = {}
    for i, t in docs:
        w = word_list(t)
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in docs:
        w = word_list(t)
        gone = set()
        for k in range(len(w) - window + 1):
            f = first.get(tuple(w[k:k + window]))
            if i is not None and f is not None and f < i:
                gone |= set(range(k, k + window))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def base_rules(text):
    w = word_list(text)
    count = collections.Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
    cover = {j for k in range(len(w) - 2) if count[tuple(w[k:k + 3])] > 1 for j in (k, k + 1, k + 2)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(w) < 50 or 100 * len(cover) > 50 * len(w)
    return (len(w), sum(map(len, w)), symbols, dup, len(cover), failed)


def repetition_shares(text):
    """The share per rule of ``repetition``: later occurrences only, in word characters (lines: also in lines)."""
    w = word_list(text)
    total = max(1, sum(map(len, w)))
    out = {}
    for n in range(2, 11):
        where = collections.defaultdict(list)
        for k in range(len(w) - n + 1):
            where[tuple(w[k:k + n])].append(k)
        if n <= 4:
            often = max((len(v) for v in where.values()), default=1)
            size = max((sum(map(len, g)) for g, v in where.items() if len(v) == often), default=0)
            out[f"top_{n}"] = min(1.0, (often - 1) * size / total)
        else:
            cover = {k + j for v in where.values() for k in v[1:] for j in range(n)}
            out[f"dup_{n}"] = sum(len(w[k]) for k in cover) / total
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    again = [x for i, x in enumerate(lines) if x in lines[:i]]
    out["dup_lines"] = len(again) / max(1, len(lines))
    out["dup_line_chars"] = sum(len(x) for line in again for x in word_list(line)) / total
    return out


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], prev + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def auc(score, label):
    order = sorted(range(len(score)), key=lambda i: score[i])
    rank = {i: r for r, i in enumerate(order)}
    pos = [i for i in range(len(score)) if label[i]]
    neg = len(score) - len(pos)
    return (sum(rank[i] for i in pos) - len(pos) * (len(pos) - 1) / 2) / (len(pos) * neg)


def prefix_trie(rows):
    """(conv_id, depth) -> (parent, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of rows (conv_id, turn, role, text)."""
    convs = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in convs.items()}
    again = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        head = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        again[c] = tuple(turns.get(head, [])[:h] + own[h:])
    members = collections.defaultdict(list)
    for c, t in again.items():
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
    kids = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in kids
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1]) if k else 0
    out = {}
    for k, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(again[c]) == len(k))))
        out[min(m), len(k)] = (min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest())
    return out


def chat_digests(rows):
    """conv_id -> (n_turns, turns_sha256, loss_chars, loss_sha256) of rows (conv_id, turn, role, text)."""
    convs = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for c, v in convs.items():
        turns = [t[2:] for t in sorted(v)]
        learnt = "".join(text for role, text in turns if role == "assistant")
        said = "".join(f"{role}\n{text}\n" for role, text in turns)
        out[c] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    return out


def align(a, b):
    """Cuts and links of two token lists ``[(id, bytes)]`` that spell the same bytes: (groups string, [(i, j)])."""
    ends = [list(itertools.accumulate(len(t[1]) for t in x)) for x in (a, b)]
    starts = [[0, *e[:-1]] for e in ends]
    links = [(i, j) for i in range(len(a)) for j in range(len(b)) if max(starts[0][i], starts[1][j]) < min(ends[0][i], ends[1][j])]
    groups, i, j = [], 0, 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        p, q = ends[0].index(cut) + 1, ends[1].index(cut) + 1
        groups.append(",".join(str(t[0]) for t in a[i:p]) + "|" + ",".join(str(t[0]) for t in b[j:q]))
        i, j = p, q
    return ";".join(groups), links


def token_alignment(docs, encode_a, encode_b):
    """Rows (doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum) of ``[(doc_id, text)]``; encoders give ``[(id, bytes)]``."""
    found = []
    for i, text in docs:
        a, b = (encode_a(" " + text), encode_b(text)) if text else ([], [])
        want = (" " + (text or "")).encode()
        if not text or b"".join(t[1] for t in a) != want or b"".join(t[1] for t in b) != want:
            a, b = [], []
        groups, links = align(a, b)
        found.append((i, a, b, groups, [(a[x][0], b[y][0]) for x, y in links]))
    count = collections.Counter(p for f in found for p in f[4])
    most = collections.Counter()
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    return [(i, len(a), len(b), groups.count("|"), len(links), hashlib.sha256(groups.encode()).hexdigest() if groups else "",
             sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links)) for i, a, b, groups, links in found]
