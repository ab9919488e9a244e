import random

RND = random.Random(7)


def prose(n, seed=None):
    r = random.Random(seed) if seed is not None else RND
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(n))


SHARED = prose(60, 1)
#: Nulls, blanks, ties, repeated rows, exact and near copies, shared passages, long runs of one character.
DOCS = [
    (1, "a " + SHARED + " " + prose(40, 2)), (2, prose(30, 3) + "\n" + SHARED + ", end."), (3, prose(100, 4)), (4, prose(100, 4)), (5, prose(100, 4) + " extra"), (6, None), (7, ""), (8, " \n\t "), (9, "one two three"), (10, "ONE two  three"),
    (11, "x" * 700), (12, "é漢 " * 120), (13, "word " * 80), (None, prose(100, 4)), (14, prose(50, 5)), (14, prose(50, 6)), (15, prose(50, 7)), (15, prose(50, 7)), (16, SHARED.upper()), (17, "under the MIT license; cc-by-nc"), (18, prose(20, 8) + "\n" + prose(20, 8)), (19, prose(3000, 9)),
]


def pairs(df, *columns):
    """Rows as sorted tuples that begin with the document's id and text-independent values."""
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
