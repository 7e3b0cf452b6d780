"""Operators for training data against brute force, and their defined cases."""

import re
import textwrap
import tracemalloc
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from parcel_engine.llm import common, hmm, jaccard, licenses, packing, pfor, rules, styletree, tiling, tokens, toxicity, warc
from parcel_engine.llm.common import fold, lowest, new_folder
from parcel_engine.llm.tokens import Encoder
from parcel_engine.session import session_conf

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, hashes string, length int"
LONG = " ".join(f"w{i % 977} x{i}" for i in range(6000))
TEXTS = [
    None, "", " \n\t ", "one", "One two", "a b c d e", "a b c d e", "The cat. The cat. The cat.\nThe cat.\nThe cat.", LONG, LONG + " end",
    "été ÀÉ naïve ẞ idiot, scum! #*$%&|<>", "x " * 400, "All rights reserved.", "Released under the MIT License. All rights reserved.\nNo.",
    "end <|endoftext|> of", "a <|startoftext|> b <|endoftext|>",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", 1, "clash", "clash", 3) for i, t in enumerate(TEXTS)]
    rows += [(None, "one two three four five six", None, None, None, None, None, None), rows[5]]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, i % 3 == 0 and 1 or 0) for i in range(10)] + [(None, None, None)], "doc_id long, quality int, toxic int")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_text_statistics(docs):
    for row in rules.text_statistics(docs).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        text = row.text or ""
        w = WORD.findall(text)
        grams = Counter(zip(w, w[1:], w[2:]))
        covered = {i + k for i, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == want


def test_learned_rules_find_a_conjunction():
    rng = np.random.default_rng(1)
    x = {"a": rng.random(3000), "b": rng.random(3000)}
    bad = (x["a"] > 0.7) & (x["b"] < 0.3)
    found = rules.learn_rules(x, bad)
    hit = np.any([r.covers(x) for r in found], axis=0)
    assert (hit == bad).mean() > 0.98
    assert rules.learn_rules(x, np.zeros(3000, bool)) == []


def test_quality_rules_keep_rows_and_columns(docs, labels):
    out = rules.quality_rules(docs, labels.select("doc_id", "quality"))
    assert out.count() == docs.count()
    kept = rules.keep_good(docs, labels.select("doc_id", "quality"))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in out.where("kept").collect()}


def test_hmm_likelihood_is_exact():
    rng = np.random.default_rng(2)
    m = hmm.Model(*(lambda a, b, c: (a / a.sum(), b / b.sum(1, keepdims=True), c / c.sum(0)))(rng.random(3), rng.random((3, 3)), rng.random((hmm.CLASSES, 3))))
    sequences = [rng.integers(0, hmm.CLASSES, n) for n in (1, 7, 3, 7, 2)]
    got = hmm.Lockstep(sequences).log10(m)
    for s, value in zip(sequences, got):
        a = m.start * m.emit[s[0]]
        for c in s[1:]:
            a = (a @ m.move) * m.emit[c]
        assert np.isclose(value, np.log10(a.sum()))


def test_baum_welch_raises_the_likelihood():
    rng = np.random.default_rng(3)
    sequences = [rng.integers(0, 20, 50) + 100 * (i % 2) for i in range(40)]
    prior = np.full(hmm.CLASSES, 1 / hmm.CLASSES)
    m, scores = hmm.first_guess(prior, 2), []
    for _ in range(8):
        scores.append(sum(s.log10(m).sum() for _, s in hmm.strips(sequences)))
        parts = [s.counts(m) for _, s in hmm.strips(sequences)]
        m = hmm.reestimate(*(sum(p[k] for p in parts) for k in range(3)), prior)
    assert scores == sorted(scores) and scores[-1] > scores[0] + 500


def plain_hmm(rows, held, states, iterations):
    """The same model by loops over single texts, words by name."""
    texts = [[*WORD.findall(lower(t)), "\n"] for _, t in rows]
    learned = [t for (i, _), t in zip(rows, texts) if not held(i)]
    c = Counter(w for t in learned for w in t)
    names = sorted({w for t in texts for w in t} - {"\n"})
    (chunk,) = common.words(pa.array([" ".join(names)]), lower=False)
    hashes = dict(zip(names, chunk.hashes().tolist()))
    own = sorted(sorted((w for w in c if w != "\n"), key=lambda w: (-c[w], int(np.uint64(hashes[w]).view(np.int64))))[: hmm.OWN], key=hashes.get)
    class_of = {w: hmm.OWN + hashes[w] % hmm.SHARED for w in names} | {w: k for k, w in enumerate(own)} | {"\n": hmm.END}
    totals = np.full(hmm.CLASSES, 0.5)
    for w in c:
        totals[class_of[w]] += c[w] + (0.5 if hmm.OWN <= class_of[w] < hmm.END else 0)
    prior = totals / totals.sum()

    def posteriors(m, text, emit):
        e = np.array([emit[w] for w in text])
        alpha, beta = np.zeros(e.shape), np.ones(e.shape)
        for t in range(len(e)):
            alpha[t] = (alpha[t - 1] @ m.move if t else m.start) * e[t]
            alpha[t] /= alpha[t].sum()
        for t in range(len(e) - 2, -1, -1):
            beta[t] = m.move @ (e[t + 1] * beta[t + 1])
            beta[t] /= beta[t].sum()
        gamma = alpha * beta
        moves = [np.outer(alpha[t], e[t + 1] * beta[t + 1]) * m.move for t in range(len(e) - 1)]
        return gamma / gamma.sum(1, keepdims=True), sum((x / x.sum() for x in moves), np.zeros((states, states)))

    m = hmm.first_guess(prior, states)
    for _ in range(iterations):
        start, move, tied = np.zeros(states), np.zeros((states, states)), np.zeros((hmm.CLASSES, states))
        for text in learned:
            gamma, moves = posteriors(m, text, {w: m.emit[class_of[w]] / prior[class_of[w]] for w in text})
            start, move = start + gamma[0], move + moves
            for w, g in zip(text, gamma):
                tied[class_of[w]] += g
        m = hmm.reestimate(start, move, tied, prior)
    g = {w: np.zeros(states) for w in c}
    for text in learned:
        for w, p in zip(text, posteriors(m, text, {w: m.emit[class_of[w]] / prior[class_of[w]] for w in text})[0]):
            g[w] = g[w] + p
    n, total = sum(c.values()), sum(g.values(), np.zeros(states))
    emit = lambda w: (n * g.get(w, np.zeros(states)) / total + 0.5) / (n + 0.5 * (len(c) + 1))
    scores = []
    for text in texts:
        log, a = 0.0, m.start
        for t, w in enumerate(text):
            a = (a @ m.move if t else a) * emit(w)
            log, a = log + np.log10(a.sum()), a / a.sum()
        scores.append(log)
    return scores


@pytest.mark.parametrize("parts", [1, 5])
def test_hmm_scores(docs, parts):
    docs = docs.where("doc_id IS NULL OR doc_id NOT IN (8, 9)").repartition(parts)
    out = hmm.hmm_scores(docs, fold("doc_id", 5) == 1, states=3, iterations=2).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    tokens = [(i, [*WORD.findall(lower(t)), "\n"]) for i, t in rows]
    c = Counter(w for i, t in tokens if not held(i) for w in t)
    n = sum(c.values())
    base = lambda t: sum(np.log10((c[w] + 0.5) / (n + 0.5 * (len(c) + 1))) for w in t)
    want = sorted((str(i), held(i), len(t), sum(c[w] > 0 for w in t), n, round(base(t), 6)) for i, t in tokens)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == want
    plain = sorted((str(i), s) for (i, _), s in zip(rows, plain_hmm(rows, held, 3, 2)))
    for (i, score), r in zip(plain, sorted(out, key=lambda r: (str(r.doc_id), r.score))):
        assert i == str(r.doc_id) and abs(r.score - score) < 1e-3 * r.n_tokens


def test_hmm_emissions_add_up_and_long_texts(spark):
    rng = np.random.default_rng(6)
    n, shares = rng.integers(1, 9, 50), rng.integers(0, 65_536, (50, 4)).astype(np.uint16)
    totals, tokens = hmm.expected(n, shares).sum(0), int(n.sum())
    unseen = hmm.emissions(np.zeros(1, int), np.zeros((1, 4), np.uint16), totals, tokens, 50)
    assert np.allclose(hmm.emissions(n, shares, totals, tokens, 50).sum(0) + unseen[0], 1)
    rows = [(1, "a b c " * 200_000), (2, "a"), (3, None)]
    out = hmm.hmm_scores(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") == 2, iterations=1).collect()
    assert {r.doc_id: r.n_tokens for r in out} == {1: 600_001, 2: 2, 3: 1} and all(np.isfinite(r.score) for r in out)
    untrained = hmm.hmm_scores(spark.createDataFrame(rows[1:], "doc_id long, text string"), F.lit(True), iterations=1).collect()
    assert {(r.score, r.base_score, r.n_known, r.train_tokens) for r in untrained} == {(0.0, 0.0, 0, 0)}


def test_warc_round_trip(spark):
    page, pages = "<html>" + "é" * 200 + "</html>", []
    pages += [(i, "http://a/" + str(i), page) for i in (7, 3, 9)] + [(1, None, None), (2, "u\r\nx", "short"), (4, "u", "short"), (None, "n", page), (3, "again", page)]
    out = warc.round_trip(spark.createDataFrame(pages, "page_id long, url string, html string"))
    got = sorted((str(r.page_id), r.payload_bytes, r.record_type, str(r.refers_to), r.html) for r in out.collect())
    size = len(page.encode())
    want = [("1", 0, "response", "None", ""), ("2", 5, "response", "None", "short"), ("3", size, "response", "None", page)] + [("3", size, "response", "None", page)]
    want += [("4", 5, "response", "None", "short"), ("7", size, "revisit", "3", None), ("9", size, "revisit", "3", None), ("None", size, "revisit", "3", None)]
    assert got == sorted(want, key=lambda r: r[:4])


@given(st.lists(st.integers(1, 40), max_size=60))
@settings(deadline=None)
def test_supersteps_fill_like_best_fit_decreasing(lengths):
    counts = np.bincount(lengths, minlength=41)
    used, places = Counter(), []
    for length, rank, each, first, offset in sorted(packing.supersteps(counts, 40).rows):
        places.append((length, rank, each, first, offset))
    total = 0
    for length, n in enumerate(counts):
        own = sorted(p for p in places if p[0] == length)
        for (_, rank, each, first, offset), after in zip(own, [p[1] for p in own[1:]] + [int(n)]):
            for i in range(after - rank):
                used[first + i // each, offset + i % each * length] += length
                total += 1
    assert total == len(lengths)
    bins: dict[int, list[tuple[int, int]]] = {}
    for (sequence, offset), length in used.items():
        bins.setdefault(sequence, []).append((offset, length))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 40
    gaps: list[int] = []
    for length in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= length]
        gaps.append((fits and gaps.pop(gaps.index(min(fits))) or 40) - length)
    assert len(bins) == len(gaps)


def test_packing_and_token_files(docs):
    for op, name in (("pack", "byte_bpe_50k.json"), ("file", "word_bpe_49k.json")):
        path = public_tokenizers.path(name)
        encoder = Tokenizer.from_file(path)
        ids_of = lambda t: np.array([*encoder.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        rows = [(r.doc_id, ids_of(r.text)) for r in docs.collect()]
        if op == "pack":
            out = packing.pack_documents(docs, path).collect()
            assert Counter(r.doc_id for r in out if r.piece == 0) == Counter(i for i, _ in rows)
            for r in out:
                ids = next(x for i, x in rows if i == r.doc_id)[r.start : r.start + r.length]
                assert (len(ids), zlib.crc32(ids.tobytes())) == (r.length, r.ids_crc32) and 1 <= r.length <= 1024
        else:
            out = sorted(pfor.round_trip(docs, path).collect(), key=lambda r: r.start)
            rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
            start = 0
            for r, (i, ids) in zip(out, rows, strict=True):
                assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
                start += len(ids)


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=1500))
@settings(deadline=None, max_examples=30)
def test_blocks_round_trip(values):
    ids = np.array(values, np.uint32)
    blocks = pfor.encode_blocks(ids)
    starts = np.cumsum([0, *map(len, blocks)])[:-1]
    assert (pfor.decode_blocks(b"".join(blocks), starts) == ids).all()


@given(st.lists(st.sampled_from([" ", "\n", "\t", "a", "The", "don't", "é", "12", ",", ".", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", " \n", "\x1c", "　"]), max_size=25))
@settings(deadline=None)
def test_cut_texts_have_the_ids_of_whole_ones(parts):
    text = "".join(parts)
    for name, spaced in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        fresh = Tokenizer.from_file(public_tokenizers.path(name))
        texts = [text, "plain words, twice", text]
        want = [np.array(fresh.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        assert Encoder(public_tokenizers.path(name), spaced).encode(texts) == want


def test_parts_that_stretches_share_are_encoded_once():
    marks = [c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'"]
    text = "Alpha " + " ".join(f"{word}{m}" for m in marks for word in ("Alpha", "b\u00e9ta")) + "\nAlpha,Alpha.\nb\u00e9ta (Alpha"
    odd = [text, None, "", "\n", " ", "a \u2003b \u201cc\u201d \x85d", "e\u0301, o\u00d7o <\u0338\nE\u0301.", "it's,'s.'ll\u00e9's"]
    for name, spaced in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        path = public_tokenizers.path(name)
        whole, encoder, sent = Tokenizer.from_file(path), Encoder(path, spaced), []
        merged = encoder._merged
        encoder._merged = lambda parts, *more: sent.extend(parts) or merged(parts, *more)
        want = [np.array(whole.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in odd]
        assert encoder.encode([t or "" for t in odd]) == want
        assert sum("lpha" in part for part in sent) == 1 + spaced  # with and without a space before it
        assert encoder.encode(pa.array(odd * 2)[2:10]) == want[2:] + want[:2]


def test_texts_go_to_the_encoder_by_bytes_and_long_parts_are_not_kept():
    texts = ["a b", None, "", "\u4e2d" * (tokens.TOGETHER // 2), "c" * 3 * tokens.TOGETHER, "\u6587" * 200, "a"] * 3
    batch = pa.RecordBatch.from_pydict({"id": pa.array(range(len(texts))), "text": pa.array(texts)})
    slices = list(tokens.together(batch, 1))
    assert [t for s in slices for t in s.column(1).to_pylist()] == texts and list(tokens.together(batch.slice(0, 0), 1)) == []
    assert all(sum(len((t or "").encode()) for t in s.column(1).to_pylist()[1:]) <= tokens.TOGETHER for s in slices)
    for name, spaced in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        path = public_tokenizers.path(name)
        whole, encoder, some = Tokenizer.from_file(path), Encoder(path, spaced), ["\u6587" * 200 + ", a", "b " + "X" * 300, "\u6587" * 200]
        want = [np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in some]
        assert encoder.encode(some) == want == encoder.encode(some) and max(map(len, encoder.known)) <= tokens.LONGEST


def test_license_scan(docs):
    found = {r.doc_id: (r.license, r.licenses) for r in licenses.license_scan(docs).collect()}
    assert found[12] == ("All rights reserved", "All rights reserved")
    assert found[13] == ("MIT", "MIT,All rights reserved")
    assert found[0] == found[3] == (None, "")


def wrapped(text, width=72, mark=""):
    return "\n\n".join("\n".join(mark + line for line in textwrap.wrap(p, width)) for p in text.split("\n\n"))


GRANT, AS_IS = licenses.SENTENCES["mit-grant"][0], licenses.SENTENCES["mit-as-is"][0]
MIT = f"MIT License\n\nCopyright (c) 2020 Some One\n\n{GRANT}\n\n{licenses.SENTENCES['mit-notice'][0]}\n\n{AS_IS} IN NO EVENT SHALL THE AUTHORS BE LIABLE."
BSD = "{}\n\n1. {}\n\n2. {}".format(*(licenses.SENTENCES[f"bsd-{k}"][0] for k in ("grant", "source", "binary")))
FREE = "This program is free software{0} you can redistribute it and/or modify it under the terms of the GNU {1} as published by the Free Software Foundation{2} either version {3} of the License, or (at your option) any later version.\n\nThis program is distributed in the hope that it will be useful."
FULL = {
    "MIT": MIT, "BSD-2-Clause": BSD, "BSD-3-Clause": BSD + "\n\n3. " + licenses.SENTENCES["bsd-endorse"][0], "ISC": "ISC License\n\n" + licenses.SENTENCES["isc-grant"][0],
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at',
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one.",
    "GPL-2.0-or-later": FREE.format(";", "General Public License", ";", 2), "GPL-3.0-or-later": FREE.format(":", "General Public License", ",", 3),
    "LGPL-2.1-or-later": FREE.replace("program", "library").format(";", "Lesser General Public License", ";", "2.1"),
    "LGPL-3.0-or-later": FREE.format(":", "Lesser General Public License", ",", 3), "AGPL-3.0-or-later": FREE.format(":", "Affero General Public License", ",", 3),
    "Unlicense": "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy it.",
    "CC-BY-ND-4.0": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "CC0-1.0": "Creative Commons Legal Code\n\nCC0 1.0 Universal", "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event.",
}


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// "])
def test_whole_licences_are_found_wrapped(spark, mark):
    rows = [(name, wrapped(text, 72, mark)) for name, text in FULL.items()] + [("long", "word " * 50_000 + "\n\n" + wrapped(MIT, 40, mark))]
    out = licenses.license_scan(spark.createDataFrame(rows, "doc_id string, text string").selectExpr("*", "1 AS _all", "'own' AS license", "2 AS ids"))
    assert out.columns == ["doc_id", "text", "_all", "ids", "n_known", "sentence_ids", "license", "licenses"]
    found = {r.doc_id: r.license for r in out.collect()}
    assert found == {name: name for name in FULL} | {"long": "MIT"}


def test_tiling_finds_reordered_passages(spark):
    item = " ".join(f"i{k}" for k in range(24))
    words = item.split()
    moved = "start " + " ".join(words[12:]) + " between, " + " ".join(words[:12]) + " stop"
    docs = spark.createDataFrame([(1, moved), (2, "i0 i1 i2 i3 only five tokens i9"), (3, None), (None, item), (5, item.upper() + "!"), (5, item.upper() + "!")], "doc_id long, text string")
    items = spark.createDataFrame([(10, item), (11, "too short"), (12, None), (None, "")], "item_id long, text string")
    found = {(r.doc_id, r.item_id): (r.coverage, r.n_tiles) for r in tiling.find_leaks(docs, items).collect()}
    assert found == {(1, 10): (1.0, 2), (None, 10): (1.0, 1), (5, 10): (1.0, 1)}
    assert {r.doc_id for r in tiling.without_leaks(docs, items).collect()} == {2, 3}
    clash = docs.selectExpr("doc_id", "text", "doc_id AS key", "text AS item_text", "1 AS _key", "2 AS id")
    kept = tiling.without_leaks(clash, items)
    assert kept.columns == clash.columns and {tuple(r)[2:] for r in kept.collect()} == {(2, "i0 i1 i2 i3 only five tokens i9", 1, 2), (3, None, 1, 2)}


def plain_tiles(doc, item, shortest=5):
    """Greedy string tiling by comparing every pair of places: words of the item that tiles cover."""
    free_doc, free_item, covered = [True] * len(doc), [True] * len(item), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and free_item[i + n] and free_doc[j + n] and item[i + n] == doc[j + n]:
                    n += 1
                best = max(best, (n, -i, -j))
        n, i, j = best[0], -best[1], -best[2]
        if n < shortest:
            return covered
        covered += n
        for k in range(n):
            free_item[i + k] = free_doc[j + k] = False


def test_leaks_are_those_of_plain_tiling(spark):
    rng = np.random.default_rng(8)
    phrase = "all of them share this phrase"
    items = [f"{phrase} " + " ".join(f"i{k}x{rng.integers(9)}" for _ in range(int(rng.integers(5, 30)))) for k in range(12)]
    docs = []
    for k in range(60):
        w = items[k % 12].split()
        a, b = sorted(rng.integers(0, len(w) + 1, 2))
        docs.append(" ".join([f"d{k}", *w[b:], phrase, *w[a:b], "end", *(w[:a] if k % 2 else [])]))
    frame = lambda rows, name: spark.createDataFrame(list(enumerate(rows)), f"{name} long, text string")
    found = {(r.doc_id, r.item_id): r.coverage for r in tiling.find_leaks(frame(docs, "doc_id"), frame(items, "item_id")).collect()}
    want = {}
    for i, d in enumerate(docs):
        for j, t in enumerate(items):
            share = plain_tiles(d.split(), t.split()) / len(t.split())
            if share >= tiling.COVERAGE:
                want[i, j] = share
    assert found.keys() == want.keys() and all(np.isclose(found[k], want[k]) for k in want)


def test_factorization_machine_learns_a_pair():
    rng = np.random.default_rng(4)
    docs = [np.flatnonzero(rng.random(6) < 0.5) for _ in range(4000)]
    label = np.array([float(0 in d and 1 in d) for d in docs])
    model = toxicity.fit(np.arange(6), docs, label)
    rows = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    score = model.score(len(docs), rows, np.concatenate(docs))
    assert ((score > 0.5) == (label == 1)).mean() > 0.99


def test_score_is_that_of_all_pairs():
    rng = np.random.default_rng(9)
    m = toxicity.Machine(np.arange(8), 0.3, rng.standard_normal(8), rng.standard_normal((8, 3)))
    docs = [np.flatnonzero(rng.random(8) < 0.5) for _ in range(50)] + [np.zeros(0, int)]
    got = m.score(len(docs), np.repeat(np.arange(len(docs)), [len(d) for d in docs]), np.concatenate(docs))
    for d, value in zip(docs, got):
        z = 0.3 + sum(m.weights[i] for i in d) + sum(m.factors[i] @ m.factors[j] for i, j in combinations(d, 2))
        assert np.isclose(value, 1 / (1 + np.exp(-z)))


@pytest.mark.parametrize("rule", ["both", "either but not both"])
def test_training_finds_a_pair_among_many_terms(spark, rule):
    rng = np.random.default_rng(10)
    has = rng.random((3000, 500)) < 0.3
    label = has[:, 3] & has[:, 77] if rule == "both" else has[:, 3] ^ has[:, 77]
    rows = [(i, " ".join(f"t{k}" for k in np.flatnonzero(h)), int(y), "own", 7) for i, (h, y) in enumerate(zip(has, label))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int, score string, predicted int")
    learned = toxicity.train(docs.where("doc_id < 2000"), docs.select("doc_id", "toxic"))
    found = {r.doc_id: r.predicted for r in toxicity.toxicity(docs, learned, threshold=0.5).collect()}
    assert np.mean([found[i] == label[i] for i in range(2000, 3000)]) > 0.95
    clean = toxicity.without_toxic(docs, learned, threshold=0.5)
    assert clean.columns == docs.columns and {(r.score, r.predicted) for r in clean.collect()} == {("own", 7)}


def test_pairs_of_terms_take_little_memory():
    rng = np.random.default_rng(3)
    docs = [np.unique(rng.integers(0, 1500, 40)) for _ in range(12_000)]
    label = np.array([float({1, 2} <= set(d.tolist()) or rng.random() < 0.002) for d in docs])
    few = [d[d < 100] for d in docs]
    tracemalloc.start()
    toxicity.pair_terms(docs, label, 1500)
    assert tracemalloc.get_traced_memory()[1] < 60e6
    tracemalloc.stop()
    held = np.array([np.isin(np.arange(100), d) for d in few], float)
    chi = toxicity.worth(held.T @ held, held.T @ (held * label[:, None]), len(few), label.sum())
    gain = chi - np.maximum(np.diag(chi)[:, None], np.diag(chi))
    gain = {(i, j): gain[i, j] for i, j in combinations(range(100), 2) if gain[i, j] >= toxicity.LEAST_GAIN and (held[:, i] * held[:, j]).sum() >= 4}
    for most in (2, 20, 2048):
        best = sorted(gain, key=lambda k: (-gain[k], k))[: most // 2]
        assert toxicity.pair_terms(few, label, 100, most).tolist() == sorted({i for k in best for i in k})


def test_toxicity_cases(docs, labels):
    for known in (labels, labels.where("doc_id < 0")):
        out = toxicity.toxicity(docs, toxicity.train(docs, known))
        assert out.count() == docs.count() and out.where("score BETWEEN 0 AND 1").count() == docs.count()


def test_jaccard_components_are_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(None, "a b c d e f"), (900, ""), (901, None), (902, "x y"), (903, "X Y"), (904, "x z")]
    for g in range(25):
        base = [f"g{g}w{k}" for k in range(int(rng.integers(4, 130)))]
        passage = [f"shared{k}" for k in range(40)] if g % 3 == 0 else []
        for _ in range(12):
            text = [w if rng.random() > 0.015 else f"r{rng.integers(1 << 30)}" for w in base] + passage
            rows.append((len(rows), " ".join(text)))
    order = rng.permutation(len(rows))
    docs = spark.createDataFrame([(rows[i][0], rows[i][1], "clash") for i in order.tolist()], "doc_id long, text string, n string").repartition(5)
    sets = {}
    for i, t in rows:
        w = WORD.findall(lower(t))
        sets[i] = set(zip(*(w[k:] for k in range(5)))) if len(w) >= 5 else {tuple(w)} if w else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations([i for i in sets if sets[i] and i is not None], 2):
        common = len(sets[a] & sets[b])
        if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    want = {i: (len(sets[i]), root(i)) for i in sets}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs).collect()} == want
    assert {r.doc_id for r in jaccard.keep_one(docs).collect()} == {i for i in sets if i is None or root(i) == i}


def test_jaccard_join_runs_few_tasks(spark):
    words = [" ".join(f"g{g}w{k}" for k in range(40)) for g in range(20)]
    rows = [(g * 100 + i, text + f" own{i} end{i}") for g, text in enumerate(words) for i in range(6)]
    rows += [(5000 + g, text + " own0 end0") for g, text in enumerate(words)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    context = spark.sparkContext
    context.setJobGroup("few-tasks", "")
    try:
        with session_conf(spark, held):
            got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs).collect()}
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert got == {i: (i - 5000) * 100 if i >= 5000 else i // 100 * 100 for i, _ in rows}
    tracker = context.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("few-tasks") for s in tracker.getJobInfo(j).stageIds}
    assert sum(tracker.getStageInfo(s).numCompletedTasks for s in stages if tracker.getStageInfo(s)) < 2200


def test_extraction(spark):
    page = "<html><body><nav>menu</nav><div class='ad-box'>buy</div><article><h1>T &amp; t</h1><p>one <b>t</b>wo<br>x<p>three<script>no</script><div class=comments>c</div></article><footer>f</footer>"
    plain = "<body><div class=top>Same words</div><div class=text>Own text {}</div><!-- unclosed"
    rows = [(0, "http://h/0", page), (1, None, None), (2, "http://h/2", ""), (3, "x", "<p>a<p>b")] + [(10 + k, f"http://Site/{k}", plain.format(k)) for k in range(6)]
    out = {r.page_id: r.text for r in styletree.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out == {0: "T & t one two x three", 1: "", 2: "", 3: "a b"} | {10 + k: f"Own text {k}" for k in range(6)}


def extracted(spark, pages):
    rows = [(i, "http://h/", html) for i, html in enumerate(pages)]
    out = styletree.main_text(spark.createDataFrame(rows, "page_id long, url string, html string"))
    return {r.page_id: r.text for r in out.collect()}


def test_style_tree_judges_pages_with_an_article(spark):
    page = "<body><div class=lead>Lead of page {}</div><article><p class=text>Own text {}</p><div class=end>Same end</div></article>"
    texts = extracted(spark, [page.format(k, k) for k in range(6)])
    assert texts == {k: f"Lead of page {k} Own text {k}" for k in range(6)}


def test_copies_are_no_boilerplate(spark):
    page = "<body><div class=text><p>{}</p></div>"
    texts = ["Copied article"] * 8 + [f"Own text {k}" for k in range(4)]
    assert extracted(spark, [page.format(t) for t in texts]) == dict(enumerate(texts))
    assert extracted(spark, [page.format("Copied article")] * 3) == dict.fromkeys(range(3), "Copied article")


@pytest.mark.parametrize("names", ["content has-sidebar", "no-sidebar", "comments-open", "with-banner", "page social"])
def test_a_name_on_a_wrapper_drops_no_article(spark, names):
    pages = ["<div class='{}'><article><p>All of the text</p></article></div>", "<div class='{}'><p>All of the text</p></div><div class=ad>buy</div>", "<article class='{}'><p>All of the text</p></article>", "<form><div id='{}'><p>All of the text</p></div></form>"]
    assert set(extracted(spark, [p.format(names) for p in pages]).values()) == {"All of the text"}


def test_deep_nesting_takes_little_memory():
    tracemalloc.start()
    page = styletree.parse("<div>" * 15_000 + "deep text")
    styletree._features(page)
    assert styletree.extract(page, {}) == "deep text" and tracemalloc.get_traced_memory()[1] < 60e6
    tracemalloc.stop()


@pytest.mark.parametrize("rows", [0, 7, 300, 5000])
def test_sample_is_that_of_a_full_sort(spark, rows):
    many = spark.range(4000, numPartitions=8)
    want = [r.id for r in many.orderBy(F.xxhash64("id")).limit(rows).collect()]
    assert [r.id for r in lowest(many, F.xxhash64("id"), rows).collect()] == want


def test_jaccard_of_a_large_group_and_hot_passage(spark):
    rng = np.random.default_rng(11)
    base = [f"w{k}" for k in range(300)]
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(i, " ".join(w if rng.random() > 0.002 else f"r{rng.integers(1 << 40)}" for w in base)) for i in range(1500)]
    rows += [(10_000 + i, passage + " " + " ".join(f"s{i}x{k}" for k in range(int(rng.integers(1, 40))))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    sets = {i: set(zip(*(t.split()[k:] for k in range(5)))) for i, t in rows}
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs).collect()}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        x, y = root(a), root(b)
        if x != y and 9 * min(len(sets[a]), len(sets[b])) >= 7 * max(len(sets[a]), len(sets[b])):
            common = len(sets[a] & sets[b])
            if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                parent[max(x, y)] = min(x, y)
    assert got == {i: root(i) for i in sets}


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    rng = np.random.default_rng(12)
    prose = lambda n: " ".join(f"{w}{rng.integers(400)}" for w in rng.choice(["of", "the", "river", "stone", "walk"], n))
    item = " ".join(f"b{k}" for k in range(40))
    good = [prose(int(rng.integers(60, 150))) for _ in range(60)]
    texts = [*good, good[0], good[1] + " more", "x " * 400, None, "", f"{prose(80)} {item}", "sludge vermin filth " * 30 + prose(60)]
    rows = [(i, t, "en", "s", len(t or ""), "mine") for i, t in enumerate(texts)] + [(None, item, None, None, None, None), (0, good[0], "en", "s", 1, "mine")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
    folder = str(tmp_path / "sf")
    spark.createDataFrame([(i, int(i < 60), int(i == 66)) for i in range(67)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs.write.parquet(f"{folder}/documents.parquet")
    given, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        given = stage(spark, given, folder).cache()
        assert given.columns == docs.columns
        seen[name] = {(r.doc_id, r.text) for r in given.collect()}
        assert stage(spark, docs.limit(0), folder).count() == 0
    every = set(zip([r[0] for r in rows], [r[1] for r in rows]))
    learned = toxicity.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    toxic = {(r.doc_id, r.text) for r in toxicity.toxicity(docs, learned).where("predicted = 1").collect()}
    assert seen["toxicity"] == every - toxic
    assert not {i for i, _ in seen["quality_rules"]} & {62, 63, 64}  # too repetitive or too short
    assert 0 in {i for i, _ in seen["jaccard_join"]} and not {i for i, _ in seen["jaccard_join"]} & {60, 61}
    assert not any(item in (t or "") for _, t in seen["decontamination"])
    assert {i for i, _ in seen["decontamination"]} >= {i for i, _ in seen["jaccard_join"]} - {65, None}
    out = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in out.collect()} == {i for i, _ in seen["decontamination"]}


def test_empty_tables(spark, docs, labels):
    none, items = docs.limit(0), spark.createDataFrame([], "item_id long, text string")
    byte = public_tokenizers.path("byte_bpe_50k.json")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    for out in (
        rules.quality_rules(none, labels), rules.keep_good(none, labels), hmm.hmm_scores(none, F.lit(False), iterations=1), licenses.license_scan(none), warc.round_trip(pages),
        packing.pack_documents(none, byte), pfor.round_trip(none, byte), licenses.license_scan(none), tiling.find_leaks(none, items),
        toxicity.toxicity(none, toxicity.train(none, labels)), jaccard.jaccard_components(none), styletree.main_text(pages),
    ):
        assert out.count() == 0
    assert new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
