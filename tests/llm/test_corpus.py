"""The corpus operators against brute force, exact round trips and held-out accuracy, on small tables."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from test_near_copies import firsts
from tokenizers import Tokenizer

import corpus_pipeline
from tidewatch.llm import exact_dedup, hnsw, licences, mixing, pieces, pseudonyms, queries, simhash, site_quality, token_files, toxicity
from tidewatch.llm.common import components

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, _row string, label string"
ODD = [
    (1, "The cat  sat on the mat and ran off", "en", "a", 3, 0.5, "x", "y"),
    (2, "the cat sat\ton the mat and ran off", "en", "a", 3, None, None, None),
    (3, "The cat sat on the mat and ran off", "en", "b", 3, 0.1, "x", "y"),
    (3, "The cat sat on the mat and ran off", "en", "b", 3, 0.1, "x", "y"),
    (4, None, None, None, None, None, None, None),
    (5, "", "en", "c", 0, 0.0, "", ""),
    (None, "stupid loser", "en", "b", 1, 0.0, "", ""),
    (7, "word " * 30_000, "en", "c", 150_000, 0.0, "", ""),
    (8, "日本語テキスト" * 4000, "ja", "c", 1, 0.0, "", ""),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def reached(edges, nodes):
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in edges:
        if a == b:
            continue
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def test_components(spark):
    dice = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in dice.integers(0, 300, (200, 2))] + [(1000, i) for i in range(1001, 1100)]
    found = {r.node: r.label for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = reached(edges, {x for e in edges if e[0] != e[1] for x in e})
    assert found == want


def test_exact_dedup_odd_rows_and_hash_collisions(odd, none):
    for content_hash in (exact_dedup.hash_128, lambda text: F.lit("same")):
        rows = exact_dedup.exact_duplicates(odd, content_hash=content_hash).collect()
        by = sorted((r.doc_id or -1, r.keep_id, r.group_size, r.kept) for r in rows)
        assert by[:5] == [(-1, None, 1, True), (1, 1, 3, True), (2, 2, 1, True), (3, 1, 3, False), (3, 1, 3, False)]
        assert all(r.text_sha256 != "" for r in rows)
    sha = {r.doc_id: r.text_sha256 for r in rows}
    assert sha[4] == sha[5] == hashlib.sha256(b"").hexdigest()
    kept = exact_dedup.without_copies(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 2, 4, 7, 8]
    assert {r.doc_id: r.text for r in kept.collect()}[1] == ODD[0][1]
    assert exact_dedup.exact_duplicates(none).count() == exact_dedup.without_copies(none).count() == 0


def plain_simhash(text, shingle=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_against_all_pairs(spark, docs, odd, none):
    rows = simhash.near_duplicates(docs).collect()
    text = {r.doc_id: r.text for r in docs.collect()}
    prints = {i: plain_simhash(t) for i, t in text.items()}
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{p:016x}" for i, p in prints.items()}
    ids = sorted(prints)
    near = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    assert {r.doc_id: r.component_id for r in rows} == reached(near, ids)
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(odd).collect()}
    assert found[4] == found[5] == 4 and found[1] == found[3] == 1 and len(found) == 8
    assert simhash.near_duplicates(none).count() == 0 and simhash.one_of_each(odd).columns == odd.columns


@pytest.mark.parametrize("distance", [4, 8])
def test_dense_groups_of_fingerprints_across_tiles(spark, distance):
    dice = np.random.default_rng(3)
    prints = {0, -1}
    for centre in dice.integers(-(2**63), 2**63 - 1, 5):
        for _ in range(60):
            flips = dice.choice(64, dice.integers(0, 9), replace=False)
            prints.add(int(np.array([int(centre)]).view(np.uint64)[0] ^ np.bitwise_or.reduce(np.append(np.uint64(1) << flips.astype(np.uint64), np.uint64(0)))) - 2**63)
    prints = sorted(prints)
    rows = simhash.link_components(spark.createDataFrame([(p,) for p in prints], "fp long"), distance, group_rows=8).collect()
    near = [(a, b) for a in prints for b in prints if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= distance]
    want = reached(near, prints)
    found = {r.node: r.label for r in rows}
    assert {p: found.get(p, p) for p in prints} == want


def sainte_lague(votes, seats):
    got = [0] * len(votes)
    for _ in range(seats):
        got[max(range(len(votes)), key=lambda i: (votes[i] / (2 * got[i] + 1), -i))] += 1
    return got


def test_quotas_go_to_the_highest_quotients(spark):
    dice = np.random.default_rng(4)
    for n, seats in ((1, 5), (7, 3), (7, 100), (40, 61), (40, 17)):
        votes = dice.integers(1, 1000, n).astype(float).tolist()
        rows = [(0, i, v, seats) for i, v in enumerate(votes)]
        found = mixing.sainte_lague(spark.createDataFrame(rows, "p int, k int, votes double, seats long"), ["p"], ["k"])
        assert [r.quota for r in found.orderBy("k").collect()] == sainte_lague(votes, seats)


def test_mix(docs, odd, none):
    rows = mixing.mix(docs, block_words=16).collect()
    again = mixing.mix(docs.repartition(5), block_words=16).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in docs.collect()}
    assert {r.doc_id: r["size"] for r in rows} == size
    by = {}
    for r in rows:
        spans = sum(int(b) - int(a) for a, b in (s.split("-") for s in r.spans.split()))
        assert r.taken == r.rounds * r["size"] + spans <= 2 * r["size"]
        by.setdefault(r.source, [r.source_size, r.target, 0])[2] += r.taken
    assert abs(sum(t for _, t, _ in by.values()) - 1.5 * sum(size.values())) < 1e-6
    weights = [3.0, 1.0, 2.0] * 10
    low, high = 0.0, 1e9
    for _ in range(200):
        level = (low + high) / 2
        full = sum(min(2 * by[s][0], level * w) for s, w in zip(sorted(by), weights))
        low, high = (level, high) if full < 1.5 * sum(size.values()) else (low, level)
    for s, w in zip(sorted(by), weights):
        assert by[s][1] == pytest.approx(min(2 * by[s][0], low * w)) and abs(by[s][2] - by[s][1]) <= 32
    found = mixing.mix(odd).collect()
    assert len(found) == 9 and {r.doc_id: r["size"] for r in found}[4] == 0
    assert mixing.mix(none).count() == 0


def test_toxicity(spark, docs, odd, none):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    machine = toxicity.train(spark.read.parquet(f"{folder}/documents.parquet"), labels)
    rows = toxicity.score(spark.read.parquet(f"{folder}/documents.parquet"), machine).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.predicted == r.toxic for r in held) / len(held) > 0.9
    # The sum over pairs, written out.
    x, v = [0, 2, 3], machine.v
    raw = machine.bias + machine.w[x].sum() + sum(v[a] @ v[b] for i, a in enumerate(x) for b in x[i + 1 :])
    assert machine.scores(np.array([0, 3, 3]), np.array(x))[0] == pytest.approx(1 / (1 + np.exp(-raw)))
    scored = {r.doc_id: r for r in toxicity.score(odd, machine).collect()}
    assert len(scored) == 8 and scored[None].held_out is False and scored[4].score == scored[5].score
    assert toxicity.score(none, machine).count() == 0 and toxicity.drop_toxic(odd, machine).columns == odd.columns
    assert {r.score for r in toxicity.score(odd, None).collect()} == {0.0}
    assert toxicity.train(odd, labels.limit(0)) is None


def test_a_machine_learns_pairs():
    rows, labels = [[0], [1], [0, 1], []] * 50, [0, 0, 1, 0] * 50
    machine = toxicity.fit_machine(rows, labels, [10, 20], rounds=400)
    one, other, both = machine.scores(np.array([0, 1, 2, 4]), np.array([0, 1, 0, 1]))
    assert both > 0.8 and one < 0.3 and other < 0.3


def test_near_vectors_against_all_pairs(spark):
    dice = np.random.default_rng(5)
    centres = dice.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + dice.normal(size=16) * (0.12 if i % 3 else 1.0)).tolist(), i % 2) for i in range(400)]
    rows += [(1000 + i, rows[0][1], 0) for i in range(5)] + [(2000, None, 0), (2001, [0.0] * 16, 0), (2002, [float("nan")] * 16, 0), (2003, rows[0][1], None)]
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in hnsw.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    good = [r for r in rows if r[0] < 2000]
    x = np.array([r[1] for r in good])
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = (x @ x.T >= 0.93) & (np.array([r[2] for r in good])[:, None] == np.array([r[2] for r in good]))
    links = {(good[a][0], good[b][0]) for a, b in np.argwhere(near) if a < b}
    assert sum(n for n, _, _ in found.values()) >= 0.98 * 2 * len(links)
    assert sum(n for n, _, _ in found.values()) <= 2 * len(links)
    want = reached(links, [r[0] for r in rows])
    assert sum(found[i][1] == want[i] for i in want) >= 0.98 * len(want)
    assert [found[i] for i in (2000, 2001, 2002, 2003)] == [(0, i, True) for i in (2000, 2001, 2002, 2003)]


def test_token_files_round_trip(docs, odd, none, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    for table in (docs, odd.where("doc_id is not null")):
        rows = sorted(token_files.token_files(table, path).collect(), key=lambda r: (r.start))
        at = 0
        for r, d in zip(rows, sorted(table.collect(), key=lambda d: d.doc_id), strict=True):
            ids = [*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 2]
            assert (r.doc_id, r.start, r.n_tokens) == (d.doc_id, at, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
            at += len(ids)
    assert token_files.token_files(none, path).count() == 0
    encoder = token_files.WordEncoder(open(path, encoding="utf-8").read())
    for text in ("Ẁ T̈ ẖ don't 'S we'LL Σας ΟΔΟΣ İ 12.5 a<|endoftext|>b <|ENDOFTEXT|> !!! ..,. word.,", "\x1c a\x85b", "é É"):
        assert encoder.encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("most", [1, 2, 1000, 49408, 2**32 - 1])
def test_blocks_with_exceptions(most):
    dice = np.random.default_rng(6)
    for n in (0, 1, 127, 128, 129, 5000):
        ids = dice.integers(0, most, n, dtype=np.uint64).astype(np.uint32)
        if n:
            ids[dice.integers(0, n, n // 30)] = most
        data = token_files.write_ids(ids, np.array([n // 2, n - n // 2]), [5, None])
        found, lengths, names, named = token_files.read_ids(data)
        assert (found == ids).all() and lengths.tolist() == [n // 2, n - n // 2] and named.tolist() == [True, False]
        if n > 300:
            assert (token_files.read_ids(data, 1, 2)[0] == ids[128:256]).all()


def test_pieces_equal_the_library(docs, odd, none):
    model = queries.piece_model()
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for table, size in ((docs, 64), (odd, 1000)):
        encoded = pieces.encode(table, model, chunk_chars=size, fan=4)
        rows = encoded.collect()
        want = sorted((r.doc_id or -1, library.encode(r.text or "")) for r in table.collect())
        assert sorted((r.doc_id or -1, r.ids) for r in rows) == want
        assert max(r.n_chunks for r in rows) > 4
        texts = sorted((r.doc_id or -1, r.text) for r in pieces.decode(encoded, model).collect())
        assert texts == sorted((r.doc_id or -1, r.text or "") for r in table.collect())
    assert pieces.encode(none, model).count() == 0


def test_chunks_of_a_unigram_vocabulary_find_the_best_sum():
    dice = np.random.default_rng(7)
    names = ["<unk>", "a", "b", "c", "ab", "bc", "abc", "ca", "cab", "aa"]
    v = pieces.Vocabulary(names, [0.0, *(-dice.random(len(names) - 1)).tolist()], "unigram", {0}, dummy_prefix=False)
    for _ in range(60):
        text = "".join(dice.choice(list("abc"), 60))
        best = v.paths(text, 0, None, len(text))[len(text)][0]
        matrix = None
        for at in range(0, 60, 10):
            part = pieces.transfer(v, *pieces.chunk(text, at, 10, v.longest))
            matrix = part if matrix is None else pieces.times(matrix, part)
        assert max(matrix[pieces.START].values()) == pytest.approx(best)


def test_licences(spark, none, odd):
    text = "Some prose.\nReleased under the MIT License.\nlicensed under  the apache license, version 2.0!\nAll rights"
    table = spark.createDataFrame([(1, text, "x"), (2, None, "x"), (3, "All rights reserved.", "x")], "doc_id long, text string, unit string")
    found = sorted((r.doc_id, r.line_no, r.licence) for r in licences.licence_scan(table).collect())
    assert found == [(1, 2, "MIT"), (1, 3, "Apache-2.0"), (3, 1, "proprietary")]
    assert licences.licence_scan(none).count() == licences.licence_scan(odd).count() == 0


def test_site_quality(spark, docs, odd, none):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = site_quality.quality(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), labels).join(labels, "doc_id").collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.9
    assert site_quality.quality(odd, labels).count() == 9 and site_quality.quality(none, labels).count() == 0
    evidence = [(i, "big", "x", 0.9) for i in range(300)] + [(900, "small", "y", 0.9)] + [(901 + i, f"h{i}", "z", 0.2) for i in range(100)]
    found = {r.doc_id: r for r in site_quality.site_quality(spark.createDataFrame(evidence, "doc_id long, host string, path string, p double")).collect()}
    assert found[0].host_p > found[900].host_p  # one good document says less than many


def test_pseudonyms(spark, odd, none):
    text = "Card 4532015112830366, 4532-0151-1283-0366; bad 4532015112830367. On 2024-02-29 not 2023-02-30 from 10.0.0.255 not 300.1.1.1; 078-05-1120, GB82WEST12345698765432, +1 (988) 555-2485 4532015112830366 and jo.e_1@mail.example.com"
    table = spark.createDataFrame([(1, text, "k"), (2, text + " again", "k"), (3, None, "k"), (4, "", "k"), (5, "1" * 50_000 + "a" * 50_000, "k")], "doc_id long, text string, kinds string")
    made = pseudonyms.pseudonymised(table, "key")
    rows = {r.doc_id: r for r in made.collect()}
    assert rows[2].text == rows[1].text + " again" and rows[3].text is None and rows[4].text == "" and rows[5].n_found == 0
    assert rows[1].kinds == "card card date ip ssn iban phone card email"
    for gone in ("4532015112830366", "4532-0151-1283-0366", "2024-02-29", "10.0.0.255", "078-05-1120", "GB82WEST", "555-2485", "jo.e_1"):
        assert gone not in rows[1].text
    for kept in ("4532015112830367", "2023-02-30", "300.1.1.1", "@mail.example.com"):
        assert kept in rows[1].text
    assert len(rows[1].text) == len(text)
    cards = re.findall(r"\d{16}", rows[1].text)
    assert cards[0] == cards[2] == re.search(r"\d{4}-\d{4}-\d{4}-\d{4}", rows[1].text)[0].replace("-", "")
    assert sum(int(c) if i % 2 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(cards[0])) % 10 == 0
    back = pseudonyms.pseudonymised(made.select("doc_id", "text"), "key", back=True)
    assert {r.doc_id: r.text for r in back.collect()} == {r.doc_id: r.text for r in table.collect()}
    assert {r.text for r in pseudonyms.pseudonymised(table, "other").where("doc_id = 1").collect()} != {rows[1].text}
    assert pseudonyms.pseudonymised(odd, "key").count() == 9 and pseudonyms.pseudonymised(none, "key").count() == 0


NOTATIONS = [
    ("4532 0151 1283 0366 12/27", "card", "4532 0151 1283 0366"),
    ("4532015112830366 123", "card", "4532015112830366"),
    ("qty 3 4532015112830366", "card", "4532015112830366"),
    ("no. 3 4532 0151 1283 0366", "card", "4532 0151 1283 0366"),
    ("3782 822463 10005.", "card", "3782 822463 10005"),
    ("call 555-123-4567", "phone", "555-123-4567"),
    ("call (555) 123-4567 or", "phone", "(555) 123-4567"),
    ("+44 20 7946 0958", "phone", "20 7946 0958"),
    ("+442079460958", "phone", "2079460958"),
    ("GB82 WEST 1234 5698 7654 32 AND", "iban", "WEST 1234 5698 7654 32"),
    ("born 12/05/1990", "slashed", "12/05/1990"),
    ("born 31/12/1990", "slashed", "31/12/1990"),
    ("from 2001:0db8:85a3:0000:0000:8a2e:0370:7334,", "ipv6", "2001:0db8:85a3:0000:0000:8a2e:0370:7334"),
    ("from fe80::1ff:fe23:4567:890a", "ipv6", "fe80::1ff:fe23:4567:890a"),
]
UNTOUCHED = ["at 12:30:45", "13/13/1990", "std::move", "1.2.3", "12-34-56", "100 200 3000", "GB83 WEST 1234 5698 7654 32", "29/02/2024", "3.14159"]


def test_pseudonyms_of_common_notations(spark):
    texts = [text for text, _, _ in NOTATIONS] + UNTOUCHED
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    made = pseudonyms.pseudonymised(table, "key")
    rows = {r.doc_id: r for r in made.collect()}
    shape = lambda x: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "0", x)))
    for at, (text, kind, gone) in enumerate(NOTATIONS):
        assert rows[at].kinds == kind and gone not in rows[at].text and shape(rows[at].text) == shape(text), text
        start = text.index(gone)
        # All but the value is as it was; an account number's check digits follow the number.
        assert rows[at].text[start + len(gone):] == text[start + len(gone):]
        assert kind == "iban" or rows[at].text[:start] == text[:start]
    for at, text in enumerate(UNTOUCHED, len(NOTATIONS)):
        assert rows[at].text == text and rows[at].n_found == 0
    # One value, one pseudonym, however it is grouped.
    digits = {re.sub(r"\D", "", rows[at].text)[-16:] for at in (2, 3)} | {re.sub(r"\D", "", rows[0].text)[:16], rows[1].text[:16]}
    assert len(digits) == 1
    assert re.sub(r"\D", "", rows[7].text) == rows[8].text[1:]
    back = pseudonyms.pseudonymised(made.select("doc_id", "text"), "key", back=True)
    assert {r.doc_id: r.text for r in back.collect()} == dict(enumerate(texts))


def test_slashed_dates_are_permuted_among_valid_dates(spark):
    days = [f"{d}/{y}" for d in pseudonyms.MONTH_FIRST + pseudonyms.DAY_FIRST for y in (1999, 2000, 2001)]
    made = [r.text for r in pseudonyms.pseudonymised(spark.createDataFrame(list(enumerate(days)), "doc_id int, text string"), "key").orderBy("doc_id").collect()]
    assert len(set(made)) == len(days) and all((a[:2] > "12") == (b[:2] > "12") for a, b in zip(days, made))
    assert all(x[:5] in set(pseudonyms.MONTH_FIRST + pseudonyms.DAY_FIRST) for x in made)


def test_pipeline_stages(spark, docs, odd, none):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    table, library = docs, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for name, stage in corpus_pipeline.STAGES:
        before = table.collect()
        table = stage(spark, table, SF).cache()
        rows = table.collect()
        if name == "toxicity":
            gone = {r.doc_id for r in before} - {r.doc_id for r in rows}
            toxic = {r.doc_id for r in labels.where("toxic = 1").collect()}
            assert len(gone & toxic) >= 0.8 * len(toxic & {r.doc_id for r in before})
        elif name == "exact_dedup":
            first = {}
            for r in before:
                first[norm(r.text)] = min(r.doc_id, first.get(norm(r.text), r.doc_id))
            assert {r.doc_id for r in rows} == set(first.values())
        elif name == "simhash_near_dedup":
            # A link needs a similarity of 0.8 between whole texts, as the stage says.
            assert {r.doc_id for r in rows} == firsts({r.doc_id: r.text for r in before})
        elif name == "mix_sources":
            taken = {r.doc_id: r.taken for r in mixing.mix(spark.createDataFrame(before, docs.schema)).collect()}
            got = {}
            for r in rows:
                got[r.doc_id] = got.get(r.doc_id, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
            assert got == {i: n for i, n in taken.items() if n}
        else:
            assert sorted((r.doc_id, r.ids) for r in rows) == sorted((r.doc_id, library.encode(r.text)) for r in before)
        if name != "encode_pieces":
            assert table.columns == docs.columns
    small = odd.select(docs.columns)
    for table in (small, none.select(docs.columns)):
        for _, stage in corpus_pipeline.STAGES:
            table = stage(spark, table, SF)
        table.count()
