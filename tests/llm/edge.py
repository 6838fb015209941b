"""Rows for the edge cases of the operators."""
import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, copies int, n_lines long, row string, label string"


def edge_rows():
    """(doc_id, text) with nulls, empty and very long texts, ties, exact and near copies, shared passages."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    passage, base = prose(60), prose(120)
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "one two"), (4, "ONE two"), (5, "é à ü"), (6, base), (7, base)]
    for k in range(8, 20):  # near copies of one text
        w = base.split()
        w[rng.randrange(len(w))] = "changed"
        rows.append((k, " ".join(w)))
    rows += [(k, prose(30) + "\n" + passage + "\n" + prose(30)) for k in range(20, 26)]
    rows += [(26, "\n".join(["same line " * 30] * 5)), (27, prose(6000)), (28, "a" * 1500), (29, "É" * 450)]
    rows += [(k, prose(rng.randint(1, 80))) for k in range(30, 45)]
    return rows
