"""Small inputs that hold every awkward case: nulls, empty and long texts,
copies, repeated rows, and extra columns whose names operators use inside."""

import random

DOC_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
              "row long, w long, entity string, kept string, band int, key string, root string, v string")


def docs(spark, rows):
    return spark.createDataFrame(
        [(i, t, "en", "s", None if t is None else len(t), 1, 2, "e", "k", 3, "y", "r", "v") for i, t in rows],
        DOC_SCHEMA)


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}é" if rng.random() < 0.1 else f"word{rng.randrange(vocabulary)}"
            for _ in range(n)]


def corpus(seed=0, n=60):
    rng = random.Random(seed)
    passage = words(rng, 40)
    rows = []
    for i in range(n):
        w = words(rng, rng.choice([0, 1, 3, 12, 13, 14, 60, 150]))
        if i % 5 == 0:
            at = rng.randrange(len(w) + 1)
            w[at:at] = passage[rng.randrange(10):rng.randrange(20, 40)]
        text = ""
        for j, x in enumerate(w):
            text += x + ("\n" if j % 11 == 10 else rng.choice([" ", " ", " ", "\t", "  ", " "]))
        rows.append((i * 3 + 1, text))
    longer = [t for _, t in rows if len(t.split()) >= 60]
    for i in range(8):  # near and exact copies
        base = longer[i % len(longer)].split(" ")
        if len(base) > 30 and i % 2:
            base[rng.randrange(len(base))] = "changed"
        rows.append((1000 + i, " ".join(base)))
    rows += [(2000, None), (2001, ""), (2002, " \n\t "), (2003, "\n\nx\n"), (None, rows[6][1]), (None, None)]
    rows.append((3000, " ".join(words(rng, 5000))))
    rows.append(rows[5])  # a repeated row
    rng.shuffle(rows)
    return rows


class Union:
    """Plain union-find with the smallest element as root."""

    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def jaccard(a, b):
    both = len(a & b)
    return both / (len(a) + len(b) - both)
