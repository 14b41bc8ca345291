"""Small tables that hold every awkward case, and plain Python forms of the definitions."""

import re

LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 4000
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, size string, "
          "id string, bucket string, key string, a string, taken string, score string")
PROSE = "the quick brown fox jumps over the lazy dog while seven wizards mix ten vivid potions"

ROWS = [
    (5, "Hello world again and again", "en", "x"),
    (1, None, None, None),
    (2, "", "en", "x"),
    (3, " \t\n", "en", "y"),
    (4, "12 34 !?", None, "x"),
    (6, LONG, "en", "y"),
    (7, LONG + "omega", "fr", "z"),
    (8, "one", "fr", None),
    (8, "one", "fr", None),
    (None, "a text without an id", "en", "x"),
    (100_000, PROSE, "en", "x"),
    (100_001, PROSE, None, "x"),
    (-7, PROSE + " then rests", "en", "z"),
    (9, "日本語のテキスト です 🎉 ſ K", "ja", "é"),
]


def edge_docs(spark, rows=ROWS):
    return spark.createDataFrame(
        [(i, t, lang, source, len(t) if t else None, "s", "i", "b", "k", "a", "t", "s")
         for i, t, lang, source in rows], SCHEMA)


def no_docs(spark):
    return edge_docs(spark, [])


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingle_set(text, n):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) or frozenset([tuple(w)])


def groups(texts, n, percent=80):
    """Smallest id of every id's component, by comparing all pairs. `texts`: (id, text) pairs."""
    sets = [(i, shingle_set(t, n)) for i, t in texts if i is not None]
    parent = {i: i for i, _ in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (i, s) in enumerate(sets):
        for j, t in sets[:k]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    return {i: find(i) for i in parent}
