"""Small documents with awkward cases, and plain-Python statements of the expected results."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "size string, row string, copies string, text_hash string, class string, kept string"
)
CLASHING = ("s", "r", "c", "h", "k", "x")


def words(text):
    return WORD.findall(text or "")


def sentence(start, n):
    """n different words, the same for the same start."""
    return " ".join(f"w{start + k}x" for k in range(n))


def documents(spark, rows, source="a", lang="en"):
    """(doc_id, text) or (doc_id, text, source) as documents with columns that clash."""
    full = []
    for row in rows:
        doc_id, text, own = (*row, source)[:3]
        full.append((doc_id, text, lang, own, None if text is None else len(text), *CLASHING))
    return spark.createDataFrame(full, SCHEMA)


AWKWARD = [
    (1, "the quick  brown\n\nfox"), (2, None), (3, ""), (4, " \t\n "), (5, "a"),
    (6, "the quick  brown\n\nfox"), (7, "né café 漢字 \xa0x y"), (8, "x" * 5000),
    (9, " ".join(["long"] * 6000)), (None, "without an id"), (5, "a"),
]
