import random

import public_tokenizers
import pytest
from llm_fixtures import AWKWARD, documents, sentence
from tokenizers import Tokenizer

from tickerloom.llm import edits
from tickerloom.llm.tokens import ChunkEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)
EDITS = "doc_id long, seq long, start long, end long, replacement string, text_hash string"
PARTS = ["a", "the", " ", "  ", "\n", "'s", ".", "1", "é", "\t", "words", "\xa0", "漢字", " x"]


def size(text):
    return len(PLAIN.encode(text or "", add_special_tokens=False).ids)


def edited(text, start, end, replacement):
    start = min(max(start or 0, 0), len(text))
    end = min(max(end or 0, start), len(text))
    return text[:start] + (replacement or "") + text[end:]


@pytest.mark.parametrize("seed", range(40))
def test_a_tree_follows_its_text(seed):
    draw = random.Random(seed)
    make = lambda most: "".join(draw.choice(PARTS) for _ in range(draw.randint(0, most)))
    text = make(60)
    tree = edits.CountTree.of_text(text, ChunkEncoder(PATH))
    for _ in range(30):
        start = draw.randint(-2, len(text) + 3)
        change = (start, start + draw.randint(-1, 9), make(12))
        text = edited(text, *change)
        tree.edit(*change)
        assert tree.text() == text and tree.n_chars == len(text)
        assert tree.n_tokens == size(text)


def test_an_edit_encodes_only_its_surroundings():
    text = sentence(0, 5000)
    tree = edits.CountTree.of_text(text, ChunkEncoder(PATH))
    tree.edit(20_000, 20_003, "other words")
    assert 0 < tree.encoded_chars < 100
    assert tree.n_tokens == size(edited(text, 20_000, 20_003, "other words"))


def expected(rows, changes):
    for doc_id, text in rows:
        text, n = text or "", 0
        before = size(text)
        own = [c for c in changes if c[0] is not None and c[0] == doc_id]
        order = sorted(own, key=lambda c: (c[1], c[2] or 0, c[3] or 0, c[4] or ""))
        for change in order:
            text, n = edited(text, *change[2:5]), n + 1
        yield doc_id, n, before, size(text), len(text)


def test_edits_of_a_table(spark):
    rows = [*AWKWARD, *[(100 + i, sentence(i, 3 + i)) for i in range(30)], (5, "another five")]
    changes = [(1, 2, 4, 9, "slow"), (1, 1, 0, 3, "A"), (2, 1, 0, 0, "was null"), (3, 1, 9, 2, None),
               (4, 1, 1, 1, "x"), (5, 1, 0, 0, "b "), (5, 2, None, None, "c"), (777, 1, 0, 1, "none"),
               (None, 1, 0, 1, "lost"), (8, 1, 10, 4000, " "), (9, 1, 3, 7, "'s")]
    changes += [(100 + i % 30, i, i * 7 % 50, i * 7 % 50 + i % 9, f"new {i}.") for i in range(200)]
    changes += [(120, k, 5, 6, f"hot {k} ") for k in range(300)]
    docs = documents(spark, rows).repartition(3)
    log = spark.createDataFrame([(*c, "clash") for c in changes], EDITS).repartition(4)
    trees = edits.count_trees(docs, PATH)
    found = [tuple(r)[:5] for r in edits.apply_edits(docs, trees, log, PATH).collect()]
    key = lambda r: (str(r[0]), *r[1:])
    assert sorted(found, key=key) == sorted(expected(rows, changes), key=key)


def test_empty_tables(spark):
    docs, none = documents(spark, AWKWARD), spark.createDataFrame([], EDITS)
    trees = edits.count_trees(docs, PATH)
    found = edits.apply_edits(docs, trees, none, PATH).collect()
    assert len(found) == len(AWKWARD) and all(r["n_edits"] == 0 for r in found)
    empty = documents(spark, [])
    log = spark.createDataFrame([(1, 1, 0, 1, "x", "")], EDITS)
    assert edits.apply_edits(empty, edits.count_trees(empty, PATH), log, PATH).count() == 0
