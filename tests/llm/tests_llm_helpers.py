def brute_components(prints, budget=3):
    """id -> smallest id reachable over pairs that differ in ``budget`` bits or fewer."""
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    first = {}
    for i in ids:
        a, b = root(i), root(first.setdefault(prints[i], i))
        parent[max(a, b)] = min(a, b)
    distinct = sorted(first)
    for k, p in enumerate(distinct):
        for q in distinct[k + 1:]:
            if (p ^ q).bit_count() <= budget:
                a, b = root(first[p]), root(first[q])
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}
