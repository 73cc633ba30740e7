from __future__ import annotations

import os
import random

import pytest

from partyard.llm import token_counts as tc

pytestmark = pytest.mark.skipif(not os.path.exists(tc.VOCABULARY), reason="no vocabulary")


@pytest.fixture(scope="module")
def counts():
    with open(tc.VOCABULARY, "rb") as f:
        return tc.PieceCounts(f.read())


def whole(counts, text):
    return len(counts.encoding.encode_ordinary(text))


def test_edits_match_a_new_count(counts):
    rng = random.Random(1)
    letters = " \n\t'abcrevlstdm1230.,!é  \n\nXY😀"
    for _ in range(2500):
        tree = tc.TokenTree("".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 3, 60, 900]))), counts)
        for _ in range(rng.randint(1, 5)):
            start = rng.randint(0, len(tree.text))
            end = min(len(tree.text), start + rng.choice([0, 1, 5, 200]))
            tree.edit(start, end, "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 7]))))
            assert tree.n_tokens == whole(counts, tree.text)
            assert [n for b in tree.lengths for n in b] == list(map(len, counts.pattern.findall(tree.text)))
            assert tree.chars_sum[1] == len(tree.text)


def test_many_edits_in_one_sweep(counts):
    rng = random.Random(2)
    letters = " \n\t'abcrevlstdm1230.,!é  \n\nXY😀"
    for _ in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 3, 60, 900, 3000])))
        tree = tc.TokenTree(text, counts)
        for _ in range(3):
            places = sorted(rng.randint(0, len(tree.text)) for _ in range(2 * rng.choice([0, 1, 2, 9, 40])))
            edits = [
                (a, b, "".join(rng.choice(letters) for _ in range(rng.choice([0, 0, 1, 7, 300]))))
                for a, b in zip(places[::2], places[1::2], strict=True)
            ]
            if rng.random() < 0.5:  # short, many of them side by side
                edits = [(a, min(a + 2, b), new) for a, b, new in edits]
            expected = tc.apply_edits(tree.text, edits)
            tree.edit_all(edits)
            assert tree.text == expected and tree.n_tokens == whole(counts, expected)
            assert [n for b in tree.lengths for n in b] == list(map(len, counts.pattern.findall(expected)))
            assert tree.chars_sum[1] == len(expected)
            assert max(map(len, tree.lengths)) <= 4 * tc.BLOCK


def test_repeated_lines_cost_what_they_hold(counts):
    """As many edits as lines, all blocks emptied: no more is encoded than stays beside them."""
    text = "".join(f"line {k % 5000} of a log with some words\n" for k in range(40_000))
    tree, edits = tc.TokenTree(text, counts), tc.cleaning_edits(text)
    tree.edit_all(edits)
    assert len(edits) == 35_000 and tree.n_tokens == whole(counts, tree.text)
    assert tree.reencoded < 20 and len(tree.lengths) < 1000


def test_only_the_edited_place_is_encoded_again(counts):
    tree = tc.TokenTree("some words and more of them. " * 20_000, counts)
    tree.edit(300_000, 300_005, "other text")
    assert tree.reencoded < 12 and tree.n_tokens == whole(counts, tree.text)


def test_cleaning_edits():
    text = "a line\nwrite a@b.cd now\na line\nend 1.2.3.4\na line"
    assert tc.apply_edits(text, tc.cleaning_edits(text)) == "a line\nwrite <EMAIL> now\nend <IP>\n"


def test_query_columns(spark, counts, odd_docs, clashing_docs, no_docs):
    rows = tc.count_tokens(odd_docs).collect()
    texts = odd_docs.collect()
    assert len(rows) == len(texts)
    got = sorted((r.n_chars, r.n_tokens, r.n_tokens_edited) for r in rows)
    clean = [(d.text or "", tc.apply_edits(d.text or "", tc.cleaning_edits(d.text or ""))) for d in texts]
    assert got == sorted((len(t), whole(counts, t), whole(counts, c)) for t, c in clean)
    assert tc.count_tokens(clashing_docs).count() == len(texts)
    assert tc.count_tokens(no_docs).count() == 0
