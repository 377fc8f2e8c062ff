import random

from tidewatch.llm import pieces, queries


def test_words_that_differ_in_their_last_mark_are_encoded_once():
    v = pieces.Vocabulary(**queries.piece_model())
    asked, best = [], v.best
    v.best = lambda text: asked.append(text) or best(text)
    found = pieces.encode_whole(v, pieces.escaped(v, "of quixotry; of quixotry? of quixotry"))
    assert [x.strip(pieces.SPACE) for x in asked].count("quixotry") == 1 and not any("quixotry" in x and x[-1] in ";?" for x in asked)
    assert v.decode(found) == "of quixotry; of quixotry? of quixotry"


def test_the_walk_gives_what_merging_gives():
    v, dice = pieces.Vocabulary(**queries.piece_model()), random.Random(8)
    for alphabet in ("aeinrst", "thing.,-=", "éèhto▁", "漢a 0"):
        for _ in range(400):
            text = "".join(dice.choice(alphabet) for _ in range(dice.randrange(1, 24)))
            assert v.walk(text) == v.merged(text)


def test_states_follow_the_best_path_through_a_parents_matrices():
    v = pieces.Vocabulary(**queries.piece_model())
    text = pieces.escaped(v, "the quixotry of things that are not there " * 4)
    spans = [(at, min(at + 40, len(text))) for at in range(0, len(text) - 20, 40)]
    spans[-1] = (spans[-1][0], len(text))
    matrices = [{"no": i, "cells": pieces.pack(pieces.transfer(v, text, *span))} for i, span in enumerate(spans)]
    states = pieces._states(matrices, (0, 0), (1, 0))
    ids = [i for span, (a, b, c, d) in zip(spans, states, strict=True) for i in pieces.backtrace(v, text, *span, (a, b), (c, d))]
    assert ids == pieces.encode_whole(v, text)
    assert set(pieces.unpack(pieces._product(matrices))) == {pieces.START}
