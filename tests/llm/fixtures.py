"""Small documents with the awkward cases, and helpers."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows(n=40, seed=1):
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdefghéñ") for _ in range(r.randint(2, 9))) for _ in range(300)]
    passage = " ".join(r.choice(vocab) for _ in range(30))
    out = []
    for i in range(n):
        t = " ".join(r.choice(vocab) for _ in range(r.randint(1, 120)))
        if i % 5 == 0:
            t = t + "\n" + passage + " " + r.choice(vocab)
        out.append((i * 3, t, "en", "s0", len(t)))
    out += [(200, out[4][1], "en", "s1", None), (201, out[4][1], "en", "s1", 3), (202, None, None, None, None),
            (203, "", "en", "s0", 0), (204, "a" * 3000, "en", "s0", 3000), (205, "word  two   three \n four ", "en", "s0", 1),
            (206, "漢字 ▁ tabs\tand\r\nlines é", "ja", "s0", 2), (207, out[7][1] + " tail", "en", "s0", 1),
            (208, "a" * 3000 + "b", "en", "s0", 3001)]
    return out + [out[2]]


def docs(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, DOCS)
