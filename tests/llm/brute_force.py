"""Plain Python versions of what the operators compute."""


def edit_distance(a, b) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j - 1] + (x != y), last[j] + 1, row[j - 1] + 1))
    return row[-1]


def nearest_substring(item, text) -> int:
    """Least edits between the item and any part of the text."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        last, row = row, [i]
        for j, y in enumerate(text, 1):
            row.append(min(last[j - 1] + (x != y), last[j] + 1, row[j - 1] + 1))
    return min(row)


def components(nodes, links) -> dict:
    """The smallest node that each node reaches."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def shingles(text, size) -> set:
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    if len(words) < size:
        return {tuple(words)}
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def near_components(docs, size, percent) -> dict:
    """From ``{id: text}``, comparing all pairs."""
    sets = {d: shingles(t, size) for d, t in docs.items()}
    ids, links = sorted(sets), []
    for i, a in enumerate(ids):
        for b in ids[:i]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                links.append((a, b))
    return components(ids, links)
