"""Plain Python versions of the corpus operators, for small tables."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(lower(text))


def jaccard_classes(rows, n=5, threshold=0.8):
    """[(doc_id, class_id, n_links)] for (doc_id, text) rows."""
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    by_gram = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            by_gram[g].append(i)
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        shared = collections.Counter(j for g in s for j in by_gram[g])
        for j, k in shared.items():
            if j != i and k >= threshold * (len(s) + len(sets[j]) - k) - 1e-9:
                links[i] += 1
                parent[max(find(i), find(j))] = min(find(i), find(j))
    members = collections.defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(rows[i][0])
    least = {r: min((d for d in ids if d is not None), default=None) for r, ids in members.items()}
    return [(rows[i][0], least[find(i)], links[i]) for i in range(len(rows))]


def contamination(rows, items, span=10):
    """[(doc_id, n_words, n_hit, ids)]"""
    index = collections.defaultdict(set)
    for item_id, text in items:
        w = words(text)
        if w:
            k = min(span, len(w))
            for i in range(len(w) - k + 1):
                index[tuple(w[i:i + k])].add(item_id)
    sizes = {len(k) for k in index}
    out = []
    for doc_id, text in rows:
        w, hit, ids = words(text), set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                got = index.get(tuple(w[i:i + k]))
                if got:
                    hit.update(range(i, i + k))
                    ids |= got
        out.append((doc_id, len(w), len(hit), ",".join(sorted(str(x) for x in ids if x is not None))))
    return out


def base_spans(text, patterns, kinds):
    text, spans = text or "", []
    for kind in kinds:
        pattern, ok = patterns[kind]
        spans += [(m.start(), kinds.index(kind), m.end(), kind) for m in re.finditer(pattern, text) if ok(m)]
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(spans))


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+",
             lambda m: 12 <= len(d := re.sub("[^0-9]", "", m[0])) <= 19 and luhn(d)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15),
}
SECRETS = {
    "assign": (r"((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])|"
               r"(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
               lambda m: len(m[2]) >= 12),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 16),
}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def repetition(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_long_repeat_words, kept)"""
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)

    def cover(k):
        count = collections.Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
        return len({p for i in range(len(w) - k + 1) if count[tuple(w[i:i + k])] > 1 for p in range(i, i + k)})

    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n, short, long = len(w), cover(5), cover(10)
    failed = n < 10 or 100 * short > 20 * n
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, short, long,
            not (failed or 100 * long > 20 * n or cover(100) > 0))


def crc_ids(ids):
    return zlib.crc32(b"".join(int(i).to_bytes(4, "little") for i in ids))


def shared_passages(rows, passage=50):
    """Per row, whether it has ``passage`` consecutive words that a row of other text has as well."""
    index = collections.defaultdict(set)
    for _, text in rows:
        w = words(text)
        for i in range(len(w) - passage + 1):
            index[tuple(w[i:i + passage])].add(text)
    out = []
    for _, text in rows:
        w = words(text)
        out.append(any(len(index[tuple(w[i:i + passage])]) > 1 for i in range(len(w) - passage + 1)))
    return out


def alignment(rows, byte_tokenizer, pieces):
    """[(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)] by comparing all token pairs of a text.

    ``byte_tokenizer``: text -> [(id, bytes)] of space+text; ``pieces``: text -> [(id, bytes)].
    """
    found, counts = [], collections.Counter()
    for doc_id, text in rows:
        a, b = (byte_tokenizer(" " + text), pieces(text)) if text else ([], [])
        whole = (" " + (text or "")).encode()
        if not text or b"".join(t for _, t in a) != whole or b"".join(t for _, t in b) != whole:
            a = b = []
        ranges = []
        for side in (a, b):
            at, out = 0, []
            for k, t in side:
                out.append((k, at, at + len(t)))
                at += len(t)
            ranges.append(out)
        links, j = [], 0
        for x, s, e in ranges[0]:
            while j < len(ranges[1]) and ranges[1][j][2] <= s:
                j += 1
            i = j
            while i < len(ranges[1]) and ranges[1][i][1] < e:
                links.append((x, ranges[1][i][0]))
                i += 1
        shared = sorted({e for _, _, e in ranges[0]} & {e for _, _, e in ranges[1]})
        groups, lo = [], 0
        for hi in shared:
            groups.append("|".join(",".join(str(k) for k, s, e in r if lo <= s and e <= hi) for r in ranges)) if len(a) < 500 else None
            lo = hi
        counts.update(links)
        found.append((doc_id, len(a), len(b), len(shared), links, ";".join(groups) if len(a) < 500 else None))
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    return [(d, n_a, n_b, g, len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
             None if text is None else sha(text) if text else "") for d, n_a, n_b, g, links, text in found]


def whitening(vectors, most=16):
    """(n, {key of a point: deviation}, V, e) for vectors of one length: exact sums, then a plain eigendecomposition."""
    import numpy as np

    points = {tuple(int(np.floor(64 * float(c))) + 1_000_000 for c in v) for v in vectors}
    n, d = len(points), len(next(iter(points)))
    total = [sum(p[j] for p in points) for j in range(d)]
    centred = np.array([[(n * p[j] - total[j]) / n for j in range(d)] for p in sorted(points)])
    e, v = np.linalg.eigh(centred.T @ centred / n)
    return n, total, v[:, ::-1][:, :most], e[::-1]


def near_vectors(rows, least=0.9):
    """[(key, n_links, component)] for (key, vector) rows, by comparing all pairs."""
    import numpy as np

    ok = [i for i, (_, v) in enumerate(rows) if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and any(c != 0 for c in v)]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    unit = {i: np.array(rows[i][1], float) / np.linalg.norm(np.array(rows[i][1], float)) for i in ok}
    for i in ok:
        for j in ok:
            if i < j and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= least:
                links[i] += 1
                links[j] += 1
                parent[max(find(i), find(j))] = min(find(i), find(j))
    members = collections.defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(rows[i][0])
    least_key = {r: min((k for k in ks if k is not None), default=None) for r, ks in members.items()}
    return [(rows[i][0], links[i], least_key[find(i)]) for i in range(len(rows))]
