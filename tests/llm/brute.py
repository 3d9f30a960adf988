"""Plain versions of what the training-data queries return."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text):
    words = WORD.findall(lower(text))
    if not words:
        return set()
    if len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def linked(a, b):
    both = len(a & b)
    return bool(a) and bool(b) and 100 * both >= 80 * (len(a) + len(b) - both)


def smallest_reachable(nodes, edges):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x] = root[root[x]]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def jaccard(rows):
    """{doc_id: (n_shingles, component_id)}; an inverted index keeps whole tables in reach."""
    sets = {k: shingles(t) for k, t in rows}
    index, edges = {}, []
    for k in sorted(sets, key=lambda k: len(sets[k])):
        counts = {}
        for s in sets[k]:
            for other in index.get(s, ()):
                counts[other] = counts.get(other, 0) + 1
        for other, both in counts.items():
            if 100 * both >= 80 * (len(sets[k]) + len(sets[other]) - both):
                edges.append((k, other))
        for s in sets[k]:
            index.setdefault(s, []).append(k)
    comp = smallest_reachable(sets, edges)
    return {k: (len(s), comp[k]) for k, s in sets.items()}


def quality(rows):
    """rows (doc_id, source, text) -> list of (doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)."""
    out, hosts = [], {}
    for key, source, text in rows:
        text = text or ""
        words = WORD.findall(text)
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        covered = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in range(i, i + 5)} if len(windows) < 3000 else set()
        lines = [x for x in text.split("\n") if WORD.search(x)]
        failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
        out.append([key, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed, source])
        n, bad = hosts.get(source, (0, 0))
        hosts[source] = (n + 1, bad + failed)
    rates = [b / n for n, b in hosts.values()]
    mean = sum(rates) / max(1, len(rates))
    var = sum((r - mean) ** 2 for r in rates) / max(1, len(rates))
    weight = 1000.0 if not var else min(1000.0, max(0.0, mean * (1 - mean) / var - 1))
    a, b = (mean * weight, (1 - mean) * weight) if len(hosts) > 1 else (1.0, 1.0)
    fine = {h: (bad + a) / (n + a + b) <= 0.5 for h, (n, bad) in hosts.items()}
    return [tuple(r[:7]) + (not r[6] and fine[r[7]],) for r in out]


def line_dedup(rows):
    """rows (doc_id, text) in order of id -> {doc_id: text}."""
    import hashlib

    seen, out = set(), {}
    for key, text in rows:
        if text is None:
            out[key] = None
            continue
        lines = text.split("\n")
        h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
        r = [-1] + [(h[i - 1] * 31 + h[i]) % 4294967291 for i in range(1, len(h))]
        chunks = [[]]
        for i, line in enumerate(lines):
            chunks[-1].append(line)
            if 0 < i < len(lines) - 2 and r[i - 1] < r[i] > r[i + 1]:
                chunks.append([])
        kept = []
        for chunk in chunks:
            body = "\n".join(chunk)
            if len(chunk) > 1 and WORD.search(body):
                if body in seen:
                    continue
                seen.add(body)
            kept.append(body)
        out[key] = "\n".join(kept)
    return out


def targets(sizes):
    """{source: size} -> {source: target} by resharing the excess until none is above its stop."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    budget, stopped = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in stopped]
        rest = budget - sum(stopped.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s: 2.0 * sizes[s] for s in free if share[s] > 2 * sizes[s]}
        if not over:
            return stopped | share
        stopped |= over


def mix(rows):
    """rows (key, source, size) -> {key: taken} with the digest of the key as the order of a source's stream."""
    import hashlib

    sizes = {}
    for _, s, n in rows:
        sizes[s] = sizes.get(s, 0) + n
    goal, taken = targets(sizes), {}
    for source in sizes:
        stream = sorted((r for r in rows if r[1] == source), key=lambda r: hashlib.md5(str(r[0]).encode()).hexdigest())
        for turn in range(2):
            at = turn * sizes[source]
            for key, _, n in stream:
                taken[key] = taken.get(key, 0) + max(0, min(n, int(goal[source] + 1e-6) - at))
                at += n
    return taken
