"""The training-data operators against brute force, and on odd input."""

from __future__ import annotations

import hashlib
import json
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from groupledger.llm import (
    bpe, decontamination, html_text, licenses, pieces, pii, quality_rules, simhash, token_files,
    toxicity, warc,
)
from groupledger.llm.common import new_folder

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, None, "en", "s", None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "a b", None, None, 3),
    (3, "  \n\n ", "en", "s", 5), (4, "x" * 200_000, "en", "s", 200_000), (5, "word " * 40_000, "en", "s", 200_000),
    (6, "é😀 ﬁ\x00　z", "fr", "s", 9),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, and columns with clashing names."""
    df = spark.createDataFrame(ODD, DOCS)
    for name in ("row", "print", "spans", "doc", "m", "key", "words", "ids", "items", "body", "kept"):
        df = df.withColumn(name, F.lit(7))
    return df


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _texts(seed: int, count: int, alphabet: list[str], most: int = 60) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, most))) for _ in range(count)]


# License scan


def test_license_places_and_notices(spark):
    notice = dict(map(reversed, licenses.NOTICES))
    gapped = licenses.NOTICES[4][1].replace("free of charge", "free of any charge").upper()
    df = spark.createDataFrame([
        (1, "Apache-License; MIT license, mit LICENSE"), (2, gapped), (3, "the apache and the license"),
        (4, "GNU General Public\nLicense"),
    ], "doc_id long, text string")
    assert notice
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert (got[1].n_base, got[1].first_word, got[1].last_word) == (3, 0, 4)
    assert got[1].base_labels == "apache,mit"
    assert (got[2].n_base, got[2].base_labels, got[2].labels) == (0, "", "mit")
    assert 0.6 <= got[2].score < 1
    assert (got[3].labels, got[3].score, got[3].first_word) == ("", 0.0, None)
    assert got[4].labels == "gpl"


def test_license_odd_input(odd, none):
    got = licenses.scan(odd).collect()
    assert len(got) == len(ODD)
    assert sum(r.n_base for r in got) == 0
    assert licenses.scan(none).count() == 0


# PII

_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _holds(kind: str, value: str) -> bool:
    digits = [int(c) for c in value if c in "0123456789"]
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else (2 * d) // 10 + 2 * d % 10 for i, d in enumerate(digits[::-1])]
        return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def _base(text: str) -> list[tuple]:
    return [(k, m.start(), m.end()) for k, p in _PATTERNS.items()
            for m in re.finditer(p, text) if _holds(k, m.group())]


def test_pii_spans_match_the_patterns(spark):
    alphabet = [*"0123456789", "@", ".", "-", "+", " ", "a@b.c", "_x", "4111111111111111", "1.2.3.4",
                "+1 (499) 555-6503", "é", "(", "\n", "255.", "256.0.0.1"]
    texts = _texts(1, 400, alphabet) + ["a.b" * 20_000, "1.1.1.1 " * 2000, "9" * 50_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = df.select("doc_id", pii.base_spans(F.col("text")).alias("s")).collect()
    for row in got:
        assert [(s.kind, s.start, s.end) for s in row.s] == _base(texts[row.doc_id])


def test_pii_terms_that_give_a_value_away(spark):
    rows = [(i, f"line {i} the quagmire of boss@firm.example here {i * 7}") for i in range(5)]
    rows += [(100 + i, f"the line of other things here {i}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.detect(df, "doc_id", "text").select("doc.*", "spans", "terms").collect()}
    text = rows[0][1]
    assert {text[s.start:s.end] for s in got[0].terms} == {"quagmire"}
    assert all(not r.spans and not r.terms for i, r in got.items() if i >= 100)
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert clean[0] == "line 0 the [TERM] of [EMAIL] here 0"
    assert clean[100] == rows[5][1]


def _terms(df) -> dict[int, set]:
    return {r.doc_id: {r.text[s.start:s.end] for s in r.terms} for r in
            pii.detect(df, "doc_id", "text").select("doc.*", "terms").collect()}


def test_pii_terms_need_evidence_and_stand_anywhere(spark):
    """Words of three texts at least, far from the value, with digits; through the domain, the
    network or the kind of the values; copies of a text are one text."""
    far = "and so on with other things " * 9
    rows = [(i, f"Desk K7 spoke. {far} mail p{i}.x@c.example, single{i}") for i in range(1, 5)]
    rows += [(10 + i, f"{far} from 10.0.7.{i} by Quagmire") for i in range(3)]
    rows += [(20 + i, f"{far} copied words say +1 (499) 555-6503") for i in range(6)]  # one text
    rows += [(30 + i, f"{far} often {'x.y@z.example' if i < 4 else ''} {i}") for i in range(9)]
    rows += [(50, f"{far} without a value"), (51, None)]

    def filled(count):
        more = [(100 + i, f"{far} mail by from desk spoke say words {i}") for i in range(count)]
        return spark.createDataFrame(rows + more, "doc_id long, text string")

    small, large = (_terms(filled(count)) for count in (300, 3000))
    assert sum(map(bool, small.values())) == 7 and all(small[10 + i] == {"Quagmire"} for i in range(3))
    assert {i: small[i] for i in small} == {i: large[i] for i in small}  # no switch by size
    assert all(small[i] == {"K7"} for i in range(1, 5))
    assert all(not small[20 + i] for i in range(6)) and all(not small[30 + i] for i in range(9))
    assert not small[50] and not small[100]
    clean = {r.doc_id: r.text for r in pii.sanitise(filled(300)).collect()}
    assert clean[1] == f"Desk [TERM] spoke. {far} mail [EMAIL], single1"


def _told(docs: list[tuple]) -> list[tuple]:
    """Per row the doc_id and the words of its text that give one of its entities away."""
    low = {c: c + 32 for c in range(65, 91)}
    counts, of, rows = {}, {}, []
    for _, text in docs:
        text = text or ""
        spans, blank = _base(text), list(text.translate(low))
        for _, start, end in spans:
            blank[start:end] = " " * (end - start)
        own = set(re.findall(pii.WORD, "".join(blank)))
        for word in own:
            counts[word] = counts.get(word, 0) + 1
        names = set()
        for kind, start, end in spans:
            value = text[start:end]
            digits = re.sub("[^0-9]", "", value)
            names |= {kind, {
                "email": f"email:@{value.translate(low).split('@')[-1]}", "ip": f"ip:{value.rpartition('.')[0]}.",
                "card": f"card:{digits[:6]}", "phone": f"phone:{digits[:4]}"}[kind],
                f"{kind}:{value.translate(low) if kind == 'email' else value if kind == 'ip' else digits}"}
        for name in names:
            of.setdefault(name, []).append((text, own))
        rows.append((names, own))
    told, z = {}, 1.645
    for name, found in of.items():
        rate, both, texts = len(found) / len(docs), {}, {}
        for text, own in found:
            for word in own:
                both[word] = both.get(word, 0) + 1
                texts.setdefault(word, set()).add(text)
        for word, n in both.items():
            k = len(texts[word])
            among = k + counts[word] - n
            share = k / among
            sure = (share + z * z / (2 * among) - z * (
                share * (1 - share) / among + z * z / (4 * among * among)) ** 0.5) / (1 + z * z / among)
            if rate < 1 and sure >= 0.5 and np.log(sure / rate) >= 0.75 * np.log(1 / rate):
                told.setdefault(name, set()).add(word)
    return sorted((i, sorted(set().union(*(told.get(n, set()) & own for n in names))))
                  for (i, _), (names, own) in zip(docs, rows, strict=True))


def test_pii_terms_of_the_given_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    want = _told([(r.doc_id, r.text) for r in docs.collect()])
    assert sum(bool(t) for _, t in want) > 0
    lower = {c: c + 32 for c in range(65, 91)}
    got = pii.detect(docs, "doc_id", "text").select("doc.*", "terms").collect()
    assert sorted((r.doc_id, sorted({r.text[s.start:s.end].translate(lower) for s in r.terms}))
                  for r in got) == want


def test_pii_query_equals_its_sql_on_rows_with_terms(spark, tmp_path):
    import duckdb

    rng, plain = random.Random(6), [f"w{i}" for i in range(300)]
    rows = []
    for i in range(400):
        said = [rng.choice(plain) for _ in range(20)]
        if i % 4 == 0:
            said += ["Desk", f"p{i}@mail{i % 3}.example", f"team{i % 3}", "é😀"]
        if i % 9 == 0:
            said += [f"10.0.{i % 2}.{i % 250}", "rack", "a4111 1111 1111 1111", "+1 (499) 555-6503,x"]
        if i % 50 == 1:
            said += ["desk", "team0"]
        rng.shuffle(said)
        rows.append((i, " ".join(said)))
    rows += rows[:40] + [(900, None), (901, ""), (None, rows[4][1])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(pii.SQL)
    got = pii.op2_pii(spark, str(tmp_path))
    assert _rows(got.select(*want.columns)) == sorted(want.fetchall(), key=repr)
    assert sum("term:" in r.spans for r in got.collect()) > 50


def test_masked_text(spark):
    rng = random.Random(4)
    rows = []
    for size in (0, 1, 30, 2000):
        spans = [(rng.choice(["ip", "term"]), a, a + rng.randint(1, 5))
                 for a in (rng.randint(0, max(0, size - 6)) for _ in range(size // 5))]
        rows.append(("".join(rng.choice("aé😀 ") for _ in range(size)), spans))
    df = spark.createDataFrame(rows, "t string, s array<struct<kind:string,start:int,end:int>>")
    for r in df.select("t", "s", pii.masked(F.col("t"), F.col("s")).alias("out")).collect():
        want, done = "", 0
        for start, end, kind in sorted((s.start, s.end, s.kind) for s in r.s):
            if start >= done:
                want += r.t[done:start] + pii.LABELS[kind]
            done = max(done, end)
        assert r.out == want + r.t[done:]


def test_pii_odd_input(odd, none):
    got = pii.sanitise(odd)
    assert got.columns == odd.columns
    assert _rows(got.select("doc_id", "text")) == _rows(odd.select("doc_id", "text"))
    assert pii.sanitise(none).count() == 0


# Pieces


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.default_vocabulary()


def test_pieces_are_the_library_s(vocabulary):
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    own = pieces.Encoder(vocabulary)
    model = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = _texts(2, 3000, [
        "a", "the", "in", "ing", " ", "  ", "\n", "é", "😀", "\0", "▁", "1", ".", "...", "http://",
        "word", "Übung", "ﬁ", "日本", "\t", "<s>", "<0x41>",
    ], 15) + ["abcdefgh" * 2000]
    for text, ids in zip(texts, own.encoded(texts), strict=True):
        assert np.frombuffer(ids, np.int32).tolist() == model.encode(text)


def test_pieces_round_trip_and_odd_input(odd, none, vocabulary):
    got = pieces.decode(pieces.encode(odd, vocabulary, "text"), vocabulary).collect()
    assert all(r.decoded == (r.doc.text or "") for r in got)
    assert [len(r.ids) for r in got if not r.doc.text] == [0, 0, 0]
    assert pieces.encode(none, vocabulary, "doc_id").count() == 0


# Toxicity


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    held = F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(4)) == 0
    model = toxicity.train(docs, labels.filter(~held))
    scored = toxicity.severity(docs, model, "doc_id").select("doc.doc_id", F.col("toxic").alias("said"))
    counts = {(r.toxic, r.said): r["count"] for r in
              scored.join(labels.filter(held), "doc_id").groupBy("toxic", "said").count().collect()}
    assert counts.get((0, True), 0) <= 0.01 * counts[0, False]
    assert counts[1, True] >= 3 * counts.get((1, False), 0)
    assert list(model.thresholds) == sorted(model.thresholds)


def test_toxicity_odd_input(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (None, 0), (2, None), (9, 0)], "doc_id long, toxic int")
    model = toxicity.train(odd, labels)
    got = toxicity.severity(odd, model, "doc_id").collect()
    assert len(got) == len(ODD)
    assert not any(r.toxic for r in got)
    assert toxicity.train(none, labels.limit(0)) == toxicity.Model()


def _toxicity_by_hand(docs, labels):
    """Fit and scores of op4 without Spark."""
    said, texts = {}, {}
    for doc, toxic in labels:
        said[doc] = max(toxic, said.get(doc, 0))
    for doc, text in docs:
        texts[doc] = min(text or "", texts.get(doc, text or ""))
    counts = {d: Counter(decontamination.tokens(texts[d].encode())) for d in sorted(said) if d in texts}
    n, bad = len(counts), sum(said[d] for d in counts)
    z = {}
    for word in set().union(*counts.values()):
        a = sum(said[d] for d in counts if word in counts[d]) + .5
        b = sum(1 - said[d] for d in counts if word in counts[d]) + .5
        c, e = bad + 1 - a, n - bad + 1 - b
        z[word] = (np.log(a / c) - np.log(b / e)) / np.sqrt(1 / a + 1 / b + 1 / c + 1 / e)
    z = {w: x for w, x in z.items() if abs(x) >= toxicity.LEAST_Z}
    names = sorted(z)
    grades, entries = [], []
    for at, (d, found) in enumerate(counts.items()):
        marks = sum(k for w, k in found.items() if z.get(w, 0) > 0)
        grades.append(said[d] and 1 + sum(marks >= s for s in toxicity.STEPS))
        entries += [(at, names.index(w), np.log1p(k)) for w, k in found.items() if w in z]
    rows, columns, values = map(np.array, zip(*entries, strict=True))
    weights, cuts = toxicity.fit(rows, columns, values, np.array(grades), len(names))
    return dict(zip(names, weights, strict=True)), cuts


def test_toxicity_is_brute_force_with_repeats_and_ties(spark):
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choices(["vile", "Awful", "fine", "calm", "day"],
                                     [4, 3, 1, 1, 5] if i % 3 == 0 else [0, 0, 3, 3, 5], k=8)))
            for i in range(150)]
    labels = [(i, int(i % 3 == 0)) for i in range(150)] + [(5, 1), (5, 0), (6, 1), (900, 1)]
    docs += [docs[6], (7, "zz other text"), (8, None), (9, ""), (9, "")]
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.train(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    weights, cuts = _toxicity_by_hand(docs, labels)
    assert {b"vile", b"awful"} <= set(model.weights) == set(weights)
    assert np.allclose([model.weights[w] for w in weights], list(weights.values()), atol=1e-6)
    assert np.allclose(model.thresholds, cuts, atol=1e-6)
    scored = toxicity.severity(df, model, "doc_id", "text").collect()
    assert len(scored) == len(docs)
    for r in scored:
        found = Counter(decontamination.tokens((r.doc.text or "").encode()))
        x = sum(weights[w] * np.log1p(k) for w, k in found.items() if w in weights)
        assert abs(r.expected_severity - (1 / (1 + np.exp(cuts - x))).sum()) < 1e-5


def test_toxicity_keeps_all_telling_words(spark):
    telling = " ".join(f"t{i}" for i in range(700))
    rows = [(i, f"{telling} plain" if i < 60 else "plain words") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(120)], "doc_id long, toxic int")
    known = toxicity.train(docs, labels).weights
    assert set(known) == {f"t{i}".encode() for i in range(700)} | {b"words"}


# Quality rules


def test_quality_counts(spark):
    texts = _texts(3, 300, ["a ", "b ", "c\n", "#", "the cat sat on a mat by it ", "\t", "é "], 90)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in df.select("doc_id", quality_rules.measured(F.col("text")).alias("m")).collect():
        text = texts[r.doc_id]
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
        covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
        lines = [x for x in text.split("\n") if x.strip(" \t\r\x0b\x0c")]
        assert (r.m.n_words, r.m.word_chars) == (len(words), sum(map(len, words)))
        assert r.m.n_symbols == text.count("#")
        assert r.m.n_dup_lines == len(lines) - len(set(lines))
        assert r.m.n_repeat_words == len(covered)
        assert r.m.base_failed == (len(words) < 20 or 100 * len(covered) > 30 * len(words))


def test_quality_lines(spark):
    good = " ".join(f"word{i}" for i in range(30)) + "."
    df = spark.createDataFrame([
        (1, f"{good}\nHome | News | Sport | Contact\nAccept all cookies"), (2, good), (3, "#$% " * 40),
        (4, "Privacy policy\n" + " | ".join("abcdefghijklmnopqrstuvwxy")),
    ], "doc_id long, text string")
    assert {r.doc_id: r.text for r in quality_rules.clean(df).collect()} == {1: good, 2: good}


def test_quality_odd_input(odd, none):
    assert quality_rules.clean(odd).columns == odd.columns
    assert quality_rules.clean(odd).count() == 0
    assert quality_rules.clean(none).count() == 0


# SimHash


def _fingerprint(text: str) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("longest", [500, 2])
def test_links_are_all_pairs(spark, monkeypatch, longest):
    monkeypatch.setattr(simhash, "LONG_LIST", longest)
    rng = random.Random(5)
    prints = {0, (1 << 64) - 1}
    for _ in range(12):
        centre = rng.getrandbits(64)
        prints |= {centre ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 4))) & (1 << 64) - 1
                   for _ in range(25)}
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    got = _rows(simhash.links(spark.createDataFrame([(x,) for x in signed], "print long")))
    mask = (1 << 64) - 1
    assert got == sorted(((a, b) for a in signed for b in signed
                          if a < b and ((a ^ b) & mask).bit_count() <= 3), key=repr)


def test_near_duplicates(spark):
    base = " ".join(f"w{i}" for i in range(400))
    texts = [base, base.upper(), base + " end", None, "", "a", "one two", " ".join(f"v{i}" for i in range(50))]
    df = spark.createDataFrame([(10 - i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in simhash.near_duplicates(df).collect()}
    for i, text in enumerate(texts):
        assert int(got[10 - i].fingerprint, 16) == _fingerprint(text or "")
    prints = {k: int(r.fingerprint, 16) for k, r in got.items()}
    least = {k: k for k in prints}
    for _ in prints:
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 3:
                    least[a] = least[b] = min(least[a], least[b])
    assert {k: r.component_id for k, r in got.items()} == least


def test_simhash_keeps_one_of_each(odd, none):
    got = simhash.one_of_each(odd)
    assert got.columns == odd.columns
    ids = [r.doc_id for r in got.collect()]
    assert 1 in ids and 2 not in ids and len(ids) == len(set(ids))
    assert simhash.one_of_each(none).count() == 0


def test_simhash_keeps_one_of_each_component_whatever_the_ids(spark):
    base = " ".join(f"w{i}" for i in range(3000))
    other = " ".join(f"v{i}" for i in range(400))
    near = next(x for x in (f"{base} end{i}" for i in range(200))
                if 0 < (_fingerprint(x) ^ _fingerprint(base)).bit_count() <= 3)
    rows = [(1, base), (1, other), (2, base), (None, other)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert _rows(simhash.one_of_each(df)) == _rows(df.limit(2))
    df = spark.createDataFrame([(None, base), (None, near), (None, other)], "doc_id long, text string")
    texts = {r.text for r in simhash.one_of_each(df).collect()}
    assert len(texts) == 2 and other in texts


# WARC


def test_warc_round_trip(spark):
    long = "<p>" + "é" * 1000
    rows = [(1, "http://a/x", long), (5, "http://a/\r\ny", long), (5, "http://b", long), (2, None, "short"),
            (3, "u", "short"), (4, "u", None), (None, "u", long), (7, "u", "<b>" * 400_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = new_folder(spark, "warc-test")
    index = warc.write(df, folder)
    got = _rows(warc.read(index, folder))
    want = []
    for page, _, html in rows:
        data = (html or "").encode()
        other = 5 if html == long and page != 5 else None
        want.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if other else "response", other))
    assert got == sorted(want, key=repr)
    one = warc.read(index.filter("page_id = 2"), folder).collect()
    assert [r.payload_bytes for r in one] == [5]
    empty = new_folder(spark, "warc-test")
    assert warc.read(warc.write(df.limit(0), empty), empty).count() == 0


# Token files


def test_token_files(spark, odd, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    own, whole = token_files.Encoder(path), Tokenizer.from_file(path)
    texts = _texts(6, 3000, [*" \n\tab1'é　\x85\x1c,.", "  ", "<|endoftext|>", "'s", " a", "word"], 12)
    for text, ids in zip(texts, own.encoded(texts), strict=True):
        assert np.frombuffer(ids, own.kind).tolist() == [*whole.encode(text, add_special_tokens=False).ids, 2]
    folder = new_folder(spark, "tokens-test")
    got = token_files.read(token_files.write(odd, path, folder), folder).orderBy("start").collect()
    start = 0
    rows = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0))
    for row, r in zip(rows, got, strict=True):
        ids = [*whole.encode(row[1] or "", add_special_tokens=False).ids, 2]
        assert tuple(r) == (row[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    folder = new_folder(spark, "tokens-test")
    assert token_files.read(token_files.write(none, path, folder), folder).count() == 0


def _cut_ids(data, texts):
    model = bpe.Model(data)
    encoder = token_files.CutEncoder(data, model.lengths, tuple(model.special))
    for some in token_files.chunks(pa.array(["", *texts]).slice(1)):
        for ids, sizes in encoder.encoded(some):
            yield from (x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1]))


def test_cut_texts_have_the_tokenizers_ids(monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as file:
        own = file.read()
    other = json.loads(own)  # has tokens for runs of white space and marks, too, so that wrong cuts show
    ids, merges = other["model"]["vocab"], other["model"]["merges"]
    for a, b in [("Ġ", "Ġ"), ("Ċ", "Ċ"), ("Ċ", "Ġ"), ("Ġ", "Ċ"), ("Âł", "Ġ"), ("Ġ", "Âł"), ("a", "."), (".", "a")]:
        ids.setdefault(a + b, len(ids))
        merges.insert(0, [a, b] if isinstance(merges[0], list) else f"{a} {b}")
    other["added_tokens"][0]["id"] = len(ids)
    parts = [*" \n\tab1'é×“\u00a0\u2003\u2028\u3000\x85\x1c\r,._漢", "  ", "<|endoftext|>", "<|endof", "text|>", "'s", " a"]
    texts = ["", *_texts(8, 2000, parts, 14), "x" * 50_000, " " * 50_000, "word, " * 9_000]
    for data in (own, json.dumps(other).encode()):
        want = [x.ids for x in Tokenizer.from_buffer(data).encode_batch(texts, add_special_tokens=False)]
        assert list(_cut_ids(data, texts)) == want
        with monkeypatch.context() as small:
            for name in ("CHUNK", "RUN", "GATHERED"):
                small.setattr(token_files, name, 40)
            assert list(_cut_ids(data, texts)) == want
    assert list(_cut_ids(own, [])) == []


def test_pieces_go_through_the_tokenizer_once(monkeypatch):
    import public_tokenizers

    seen = []

    class Counting:
        def __init__(self, tokenizer):
            self.tokenizer = tokenizer

        def encode_batch_fast(self, texts, **more):
            seen.extend(texts)
            return self.tokenizer.encode_batch_fast(texts, **more)

    real = token_files._tokenizer
    monkeypatch.setattr(token_files, "_tokenizer", lambda data: Counting(real(data)))
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as file:
        list(_cut_ids(file.read(), [f"one two, three {i % 7}." for i in range(1000)]))
    assert sum(map(len, seen)) < 50


def test_token_files_leaves_the_words_to_the_tasks(spark, odd, monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(bpe, "split_words", None)  # a regular expression in Spark was nearly a third of the job
    folder = new_folder(spark, "tokens-test")
    parts = token_files.write(odd, public_tokenizers.path("byte_bpe_50k.json"), folder)
    assert token_files.read(parts, folder).count() == len(ODD)


# HTML


def test_article_text():
    page = html_text.parse(
        "<html><head><title>T</title></head><body><header>H</header><nav><ul><li>n</ul></nav>"
        "<div class='ad'>buy</div><article><h1>Title &amp; more</h1><p><b>one\n two<br><p>three"
        "<form><input></form><ul><li>a<li>b</ul><script>x='</p>'</script><!-- no -->"
        "<section id=comments><p>reply</p></section></article><aside>s</aside><footer>f</footer>"
    )
    assert html_text.parts(page)[0] == "Title & more\none two\nthree\na\nb"
    assert html_text.parts(html_text.parse(""))[0] == ""
    assert html_text.parts(html_text.parse("<div>" * 3000 + "x"))[0] == "x"


def test_only_whole_names_say_furniture():
    page = html_text.parse(
        "<article><p>one<section id='related-work'><p>two</section>"
        "<div class='search-algorithms'><p>three</div><div class='search'><p>gone</div>"
        "<div class='box Share'><p>gone</div><p role=note>four</article>"
    )
    assert html_text.parts(page)[0] == "one\ntwo\nthree\nfour"


def test_names_that_are_no_furniture_go_by_recurrence(spark):
    def html(i: int, menu: str) -> str:
        return (f"<body><div class='nav-left'><a href=/>{menu}</a></div><article><h1>T{i}</h1>"
                f"<p>Body {i}</p><div class='share-box'>{menu}</div></article>")

    rows = [(i, f"https://same.example/{i}", html(i, "Menu")) for i in range(20)]
    rows += [(100 + i, f"https://other{i}.example/", html(i, "Menu")) for i in range(20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract(df).collect()}
    assert all(got[i] == f"T{i}\nBody {i}" for i in range(20))
    assert all(got[100 + i] == f"T{i}\nBody {i}\nMenu" for i in range(20))


def test_very_long_page():
    body = "".join(f"<p>part {i} of the text" for i in range(100_000))
    text = html_text.parts(html_text.parse(f"<article>{body}</article>"))[0]
    assert text.count("\n") == 99_999 and text.endswith("part 99999 of the text")


def test_site_template_goes(spark):
    rows = [(i, f"https://h{i % 2}.example/{i}",
             f"<body><div class=top>Site {i % 2} <i>x</i></div><h2>T{i}</h2><p>Body {i}<div>same</div>")
            for i in range(30)]
    copies = [(100 + i, f"https://copy.example/{i}", "<body><div>whole text</div>") for i in range(30)]
    odd = [(None, None, None), (200, "https://h0.example/", ""), (200, "https://h0.example/", "")]
    df = spark.createDataFrame(rows + copies + odd, "page_id long, url string, html string")
    got = html_text.extract(df.withColumn("text", F.lit("clash"))).collect()
    assert len(got) == len(rows + copies + odd)
    by_id = {r.page_id: r for r in got}
    assert by_id[3].text == "T3\nBody 3"
    assert by_id[100].text == "whole text"
    assert (by_id[None].text, by_id[200].n_chars) == ("", 0)


def test_all_articles_count():
    def text(html: str) -> str:
        page = html_text.parse(html)
        first = html_text.parts(page)[0]
        assert html_text.without(page, frozenset()) == first
        return first

    teaser = "<article><a href=/x>Read the other story</a> now</article>"
    page = f"<body><article><p>one<p>two</article>{teaser}<div><article>a longer third</article></div>"
    assert text(page) == "one\ntwo\na longer third"
    assert text(f"<body>{teaser}{teaser}") == "\n".join(["Read the other story now"] * 2)
    assert text("<main>one</main><main><a>t</a></main>") == "one"


def test_running_elements_that_recur_go(spark):
    menu = "<ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul><table><tr><td><a>Top</a></table>"
    said = "See <b>Home</b> and <a href=/a>Home</a> of"
    rows = [(i, f"https://few.example/{i}",
             f"<body>{menu}<a>Log in</a><h2>T{i}</h2><p>{said} {i}<p>All rights are ours.") for i in range(4)]
    shared = "".join(f"<p>Passage {i} of a text" for i in range(9))
    rows += [(10 + i, f"https://mirror.example/{i}", f"<body>{shared}<p>Own {i}") for i in range(12)]
    rows += [(30 + i, f"https://two.example/{i}", f"<body><p>One {i}<p>Twice") for i in range(2)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract(df).collect()}
    assert [got[i] for i in range(4)] == [f"T{i}\nSee Home and Home of {i}" for i in range(4)]
    copy = [f"Passage {i} of a text" for i in range(9)]
    assert [got[10 + i] for i in range(12)] == ["\n".join([*copy, f"Own {i}"]) for i in range(12)]
    assert got[30] == "One 0\nTwice"


# Decontamination


def _hits(text: str, items: list[tuple[int, str]]) -> tuple[int, list[str]]:
    words = decontamination.tokens(text.encode())
    hit, names = set(), set()
    for name, item in items:
        own = decontamination.tokens(item.encode())
        size = min(10, len(own))
        for i in range(len(own) - size + 1) if own else ():
            for at in range(len(words) - size + 1):
                if words[at:at + size] == own[i:i + size]:
                    hit.update(range(at, at + size))
                    names.add(str(name))
    return len(hit), sorted(names)


@pytest.mark.parametrize("block", [2_000_000, 60])
def test_decontamination_is_brute_force(spark, block):
    rng = random.Random(8)
    items = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 16)))) for i in range(12)]
    texts = _texts(9, 150, ["a ", "b ", "c ", "A, ", "x "], 40) + [x for _, x in items]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.match(df, bench, "doc_id", block_bytes=block).collect()
    assert len(got) == len(texts)
    for r in got:
        n_hit, names = _hits(texts[r.doc.doc_id], items)
        assert (sum(s.end - s.start for s in r.spans), r["items"]) == (n_hit, names)


def test_decontamination_of_equal_words_is_quick():
    short = [("s", [b"w"] * n) for n in range(1, 10)]
    own = decontamination.Automaton([("long", [b"w"] * 1600), *short])
    began = time.process_time()
    spans, names = own.hits([b"w"] * 4000 + [b"x"] + [b"w"] * 5)
    assert time.process_time() - began < 1
    assert (spans, names) == ([(0, 4000), (4001, 4006)], {"long", "s"})


def test_automata_come_from_tasks_and_repeats_count_once(spark):
    items = [(i % 40, f"word{i % 40} " * 12) for i in range(400)] + [(None, "lone one")] * 3
    bench = spark.createDataFrame(items, "item_id long, text string")
    built = list(decontamination.automata(bench, 700))
    assert len(built) > 3
    assert sorted(x for own in built for x in own.names) == sorted([*map(str, range(40)), "null"])
    df = spark.createDataFrame([(7, "a lone one"), (7, "a lone one"), (8, None)], "doc_id long, text string")
    got = decontamination.match(df, bench, "doc_id", block_bytes=700, cut=True).collect()
    assert sorted((r.doc.doc_id, r["items"], r.rest) for r in got if r.rest) == [(7, ["null"], "a ")] * 2
    assert [(r.n_words, r.spans, r.rest) for r in got if r.doc.doc_id == 8] == [(0, [], None)]


def test_decontaminated_text(spark, odd, none):
    leak = "one two three four five six seven eight nine ten"
    bench = spark.createDataFrame([(1, leak), (None, None), (2, "")], "item_id long, text string")
    around = " ".join(f"w{i}" for i in range(20))
    df = spark.createDataFrame(
        [(1, f"{around}, {leak.title()}; {around}", 9), (2, around, 9), (3, leak, 9), (4, None, 9)],
        "doc_id long, text string, n_chars long",
    )
    got = {r.doc_id: r.text for r in decontamination.decontaminate(df, bench).collect()}
    assert got == {1: f"{around}, ; {around}", 2: around, 4: None}
    left = decontamination.decontaminate(odd, bench)
    assert left.columns == odd.columns
    assert _rows(left.select("doc_id", "text")) == _rows(odd.select("doc_id", "text"))
    assert decontamination.decontaminate(none, bench).count() == 0
    assert decontamination.decontaminate(odd, bench.limit(0)).count() == len(ODD)
