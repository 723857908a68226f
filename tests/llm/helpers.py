"""Small hand-made tables and brute-force versions for the operator tests."""

from collections import Counter

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LABEL_SCHEMA = "doc_id long, quality int, toxic int"


def documents(spark, rows):
    """rows: (doc_id, text[, lang, source])."""
    full = [(r[0], r[1], (*r, "en")[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOC_SCHEMA)


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.select(*columns).collect()), key=repr)


def shingles(text):
    w = (text or "").encode().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def links_and_classes(docs):
    """[(doc_id, class_id, n_links)] by comparing shingle sets of all rows that share a shingle."""
    sets, holders = [shingles(t) for _, t in docs], {}
    parent, links = list(range(len(docs))), [0] * len(docs)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        for j, k in Counter(j for g in s for j in holders.get(g, ())).items():
            if 5 * k >= 4 * (len(s) + len(sets[j]) - k):
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
        for g in s:
            holders.setdefault(g, []).append(i)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, least.get(find(i)) if sets[i] else d, links[i]) for i, (d, _) in enumerate(docs)]
