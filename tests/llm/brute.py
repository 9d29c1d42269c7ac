"""Plain versions of the operators, for small inputs."""

import re


def shingle_set(text, n=5):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def near_groups(docs):
    """docs: (doc_id, text). {doc_id: (n_shingles, component_id)}"""
    sets = [(i, shingle_set(t)) for i, t in docs]
    root = {i: i for i, _ in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                i_, j_ = find(i), find(j)
                root[max(i_, j_)] = min(i_, j_)
    return {i: (len(s), find(i)) for i, s in sets}


def cut_repeats(docs, window):
    """docs: (doc_id, text). {doc_id: (n_bytes, n_removed, n_spans, kept)}"""
    raws = [(i, (t or "").encode()) for i, t in docs]
    seen = {}
    for _, raw in raws:
        for p in range(len(raw) - window + 1):
            seen[raw[p : p + window]] = seen.get(raw[p : p + window], 0) + 1
    out = {}
    for i, raw in raws:
        gone = bytearray(len(raw))
        for p in range(len(raw) - window + 1):
            if seen[raw[p : p + window]] > 1:
                gone[p : p + window] = b"\1" * window
        spans = sum(1 for p, g in enumerate(gone) if g and (p == 0 or not gone[p - 1]))
        out[i] = len(raw), sum(gone), spans, bytes(b for b, g in zip(raw, gone) if not g)
    return out


def cut_words(docs, window):
    """{doc_id: (spans of bytes, kept)} by every window of words."""
    found = {i: [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", (t or "").encode())] for i, t in docs}
    raws = {i: (t or "").encode() for i, t in docs}
    seen = {}
    for i, places in found.items():
        tokens = [raws[i][a:b].lower() for a, b in places]
        for p in range(len(tokens) - window + 1):
            seen.setdefault(tuple(tokens[p : p + window]), []).append((i, p))
    gone = {i: set() for i in found}
    for where in seen.values():
        if len(where) > 1:
            for i, p in where:
                gone[i].update(range(p, p + window))
    out = {}
    for i, places in found.items():
        runs = []
        for p in sorted(gone[i]):
            if runs and p == runs[-1][1]:
                runs[-1][1] = p + 1
            else:
                runs.append([p, p + 1])
        spans = [(places[a][0], places[b - 1][1]) for a, b in runs]
        edges = [0, *[x for s in spans for x in s], len(raws[i])]
        out[i] = spans, b"".join(raws[i][a:b] for a, b in zip(edges[::2], edges[1::2]))
    return out
