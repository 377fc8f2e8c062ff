"""The pipeline's near-copy stage against the brute-force similarity of whole texts."""

import re

import numpy as np
import pytest

import corpus_pipeline
from tidewatch.llm import near_copies

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def firsts(texts):
    sets = {i: plain_set(t) for i, t in texts.items()}
    up = {i: i for i in texts}
    for a in sorted(texts):
        for b in sorted(texts):
            same = len(sets[a] & sets[b])
            if a < b and (sets[a] == sets[b] or same and 9 * same >= 4 * (len(sets[a]) + len(sets[b]))):
                low, high = sorted((up[a], up[b]))
                up = {i: low if x == high else x for i, x in up.items()}
    return set(up.values())


def changed(dice, words, edits):
    words = list(words)
    for at in dice.choice(len(words), edits, replace=False):
        words[at] = f"n{dice.integers(10**9)}"
    return words


@pytest.mark.parametrize("group_rows", [256, 8])
def test_near_copies_are_those_whole_texts_say(spark, group_rows):
    dice = np.random.default_rng(9)
    texts = {}
    for _ in range(30):
        base = [f"w{x}" for x in dice.integers(0, 5000, 300)]
        for edits in (0, 2, 5, 7, 9, 12):
            texts[len(texts)] = " ".join(changed(dice, base, edits))
    base = [f"w{x}" for x in dice.integers(0, 5000, 200)]
    for _ in range(60):
        texts[len(texts)] = " ".join(changed(dice, base, dice.integers(0, 9)))
    texts |= {900: None, 901: "", 902: "A few words", 903: "a few  words", 904: "word " * 30_000}
    table = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in texts.items()], SCHEMA)
    want = firsts(texts)
    rows = near_copies.one_of_each(table, group_rows=group_rows).collect()
    assert {r.doc_id for r in rows} == want and len(rows) == len(want)
    if group_rows == 256:
        assert {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, table, "").collect()} == want
