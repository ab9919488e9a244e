import hashlib
import io
import re
import zlib

import numpy as np
import pytest
from llm_helpers import DOCS, SHARED, pairs, prose

from readloom.llm import decontaminate, html_extract, licenses, pieces, quality, token_store, warc

public_tokenizers = pytest.importorskip("public_tokenizers")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(t):
    return ALNUM.findall((t or "").translate(FOLD))


# --- token store ---------------------------------------------------------------------------------


def test_store_round_trip(spark, docs, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    token_store.write(docs, f"file://{tmp_path}/s", path)
    got = token_store.read(spark, f"file://{tmp_path}/s").collect()
    ids = {}
    for d, t in DOCS:
        ids.setdefault(d, []).append(tuple(tok.encode(t or "", add_special_tokens=False).ids) + (0,))
    assert len(got) == len(DOCS)
    start = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == start and tuple(r.ids) in ids[r.doc_id]
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted((d for d, _ in DOCS if d is not None)) + [None]
    some = token_store.read(spark, f"file://{tmp_path}/s", doc_ids=[3, 14]).collect()
    assert sorted(r.doc_id for r in some) == [3, 14, 14]
    assert {tuple(r.ids) for r in some} == set(ids[3]) | set(ids[14])


def test_store_of_nothing(spark, none, tmp_path):
    token_store.write(none, f"file://{tmp_path}/s", public_tokenizers.path("byte_bpe_50k.json"))
    assert token_store.read(spark, f"file://{tmp_path}/s").count() == 0


def test_encoder_equals_the_library():
    import random

    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok, enc, r = Tokenizer.from_file(path), token_store.Encoder(path), random.Random(1)
    texts = ["".join(r.choice("ab 'sré\n\t\r ²1½9ªº·×÷ɏ漢.!,$l\x85\xa0") for _ in range(r.randint(0, 40))) for _ in range(3000)] + ["<|endoftext|> x", "don't we'll  go "]
    assert [list(np.frombuffer(i, "<u4")) for i in enc.encode(texts)] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_pieces_by_the_model_equal_the_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok, enc = Tokenizer.from_file(path), token_store.Encoder(path)
    pieces = [" " + w for w in prose(300, 11).split()] + [" é", "ªº", " 12", "...", "\t\n", " Ünïcödé"]
    assert enc.plain and enc._pieces(pieces) == enc._direct(pieces)
    other = token_store.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert not other.plain and [list(np.frombuffer(i, "<u4")) for i in other.encode(["One Two"])] == [Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode("One Two", add_special_tokens=False).ids]


def test_one_text_of_new_pieces_does_not_outgrow_the_cache(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_store, "CACHE_ENTRIES", 10)
    monkeypatch.setattr(token_store, "YOUNG_ENTRIES", 5)
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok, enc = Tokenizer.from_file(path), token_store.Encoder(path)
    texts = [" ".join(f"w{i}x" for i in range(k, 100 + k)) for k in (0, 3)] + ["", "w7x w1x"]
    assert [list(np.frombuffer(i, "<u4")) for i in enc.encode(texts)] == [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(enc.kept) == 10 and 0 < len(enc.kept.young) <= 5


def test_rows_without_id_are_stored_last(spark, tmp_path):
    rows = [(None, prose(20, i)) for i in range(30)] + [(7, "seven"), (7, "seven")]
    path = public_tokenizers.path("byte_bpe_50k.json")
    token_store.write(spark.createDataFrame(rows, "doc_id long, text string"), f"file://{tmp_path}/s", path)
    got = sorted(token_store.read(spark, f"file://{tmp_path}/s").collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [7, 7] + [None] * 30
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(len(got))]


# --- WARC ----------------------------------------------------------------------------------------

PAGES = [(1, "http://a", "x" * 1500), (2, "http://b", "x" * 1500), (3, None, "short"), (4, "u\r\nv", "short"), (5, "http://c", None), (6, "http://d", "é" * 90_000), (None, "http://e", "x" * 1500), (7, "http://f", "y" * 2000), (7, "http://f", "y" * 2000), (8, "g", "é" * 90_000)]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(p, u, h, "clash") for p, u, h in PAGES], "page_id long, url string, html string, digest string")


def test_warc_round_trip(spark, pages, tmp_path):
    path = f"file://{tmp_path}/w"
    warc.write(pages, path)
    want = []
    for p, _, h in PAGES:
        b = (h or "").encode()
        first = max((q for q, _, g in PAGES if (g or "").encode() == b and q is not None), default=None) if len(b) >= 1000 else p
        new = first is None or first == p
        want.append((p, len(b), hashlib.sha1(b).hexdigest(), "response" if new else "revisit", None if new else first))
    assert pairs(warc.read(spark, path), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == sorted(want, key=repr)
    table = spark.read.schema(warc.TABLE_SQL).parquet(path)
    assert table.selectExpr("max(length(data))").first()[0] <= warc.CHUNK
    found, ids = [], []
    for a in sorted({r.archive for r in table.select("archive").collect()}):
        records = list(warc.parse(io.BytesIO(b"".join(warc.archive_bytes(spark, path, a)))))
        assert records[0][0]["WARC-Type"] == "warcinfo"
        for head, _, sha in records[1:]:
            revisit = head["WARC-Type"] == "revisit"
            assert revisit or sha == head["WARC-Payload-Digest"].removeprefix("sha1:")
            found.append((int(head["X-Page-Id"]) if "X-Page-Id" in head else None, head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"], int(head["X-Refers-To-Page-Id"]) if revisit else None))
            ids.append((head["WARC-Record-ID"], head.get("WARC-Refers-To")))
    assert sorted(found, key=repr) == sorted(((p, d, k, r) for p, _, d, k, r in want), key=repr)
    assert {r for _, r in ids if r} <= {i for i, _ in ids}
    for broken, why in ((b"nothing\r\n", "no record"), (b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc", "cut off")):
        with pytest.raises(ValueError, match=why):
            list(warc.parse(io.BytesIO(broken)))


def test_many_revisits_are_joined(spark, pages, tmp_path, monkeypatch):
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    warc.write(pages, f"file://{tmp_path}/few")
    monkeypatch.setattr(warc, "SENT_ROWS", 0)
    warc.write(pages, f"file://{tmp_path}/many")
    assert pairs(warc.read(spark, f"file://{tmp_path}/many"), *columns) == pairs(warc.read(spark, f"file://{tmp_path}/few"), *columns)


def test_a_changed_payload_is_noticed(spark, pages, tmp_path):
    from pyspark.sql import functions as F

    warc.write(pages, f"file://{tmp_path}/w")
    table = spark.read.schema(warc.TABLE_SQL).parquet(f"file://{tmp_path}/w")
    table.withColumn("data", F.when(F.col("chunk_no") == 1, F.lit(b"?")).otherwise(F.col("data"))).write.parquet(f"file://{tmp_path}/v")
    with pytest.raises(Exception, match="does not fit"):
        warc.read(spark, f"file://{tmp_path}/v").collect()


def test_warc_of_nothing(spark, pages, tmp_path):
    warc.write(pages.where("page_id = -1"), f"file://{tmp_path}/w")
    assert warc.read(spark, f"file://{tmp_path}/w").count() == 0


# --- quality -------------------------------------------------------------------------------------


def brute_counts(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    dead = bytearray(len(w))
    for i, g in enumerate(grams):
        if grams.count(g) > 1:
            dead[i : i + 3] = b"\1" * 3
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, sum(dead), len(w) < 50 or 100 * sum(dead) > 50 * len(w)


def labelled(spark, n=300):
    rows, labels = [], []
    for i in range(n):
        bad = i % 3 == 0
        text = prose(60, i)
        rows.append((i, text.replace(" ", "%%% ") if bad else text))
        labels.append((i, int(not bad), 0))
    labels += [(0, None, None), (None, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_base_counts_equal_brute_force(spark, docs):
    _, labels = labelled(spark, 3)
    got = quality.rules(docs, labels)
    short = [(d, *brute_counts(t)) for d, t in DOCS]
    assert pairs(got, "doc_id", *quality.COUNTS, "base_failed") == sorted(short, key=repr)


def test_held_out_accuracy_and_calibration(spark):
    docs, labels = labelled(spark)
    model = quality.train(docs, labels, rows=200)
    got = {r.doc_id: r for r in quality.rules(docs, labels, model=model).collect()}
    assert sum(got[i].kept == (i % 3 != 0) for i in got) >= 0.97 * len(got)
    kept = quality.keep(docs, labels, model=model)
    assert {r.doc_id for r in kept.collect()} == {i for i in got if got[i].kept} and kept.columns == docs.columns


def test_without_labels_the_base_rule_decides(spark, docs, none):
    empty = labelled(spark, 3)[1].where("doc_id = -1")
    assert all(r.kept != r.base_failed for r in quality.rules(docs, empty).collect())
    assert quality.rules(none, empty).count() == 0 and quality.keep(none, empty).count() == 0


# --- pieces --------------------------------------------------------------------------------------


def test_pieces_equal_the_library(spark, docs):
    from sentencepiece import SentencePieceProcessor

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = SentencePieceProcessor(model_file=path)
    got = pieces.round_trip(docs, path)
    want = sorted(((d, sp.encode(t or ""), True) for d, t in DOCS), key=repr)
    assert pairs(got, "doc_id", "ids", "round_trip") == want
    back = pieces.decode(pieces.encode(docs, path), path)
    assert pairs(back, "doc_id", "text") == sorted(((d, t or "") for d, t in DOCS), key=repr)


@pytest.mark.parametrize("new", [40_000, 7])
def test_random_texts_equal_the_library(new, monkeypatch):
    import random

    monkeypatch.setattr(pieces, "NEW_UNITS", new)

    from sentencepiece import SentencePieceProcessor

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp, enc, dec, r = SentencePieceProcessor(model_file=path), pieces.Encoder(path), pieces.Decoder(path), random.Random(2)
    texts = ["".join(r.choice("ab th einrst\n漢ñ▁🤖\0") for _ in range(r.randint(0, 50))) for _ in range(1500)] + ["aaaaaaaaaaaaaaaaaa", " " * 33, "<s></s><unk><0x41>", "the" * 99]
    ids = enc.encode(texts)
    assert [i.tolist() for i in ids] == [sp.encode(t) for t in texts]
    assert [dec.decode(i) for i in ids] == [sp.decode(i.tolist()) for i in ids]


def test_texts_without_spaces_are_read_in_time(spark, none):
    import random
    import time

    from sentencepiece import SentencePieceProcessor

    path, r = public_tokenizers.path("piece_bpe_32k.model"), random.Random(9)
    sp, enc = SentencePieceProcessor(model_file=path), pieces.Encoder(path)
    texts = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz0123456789漢é") for _ in range(60_000)), "漢字" * 20_000, "ab" * 5_000, "x", "\n" * 300]
    began = time.process_time()
    ids = enc.encode(texts)
    assert time.process_time() - began < 8
    assert [i.tolist() for i in ids] == [sp.encode(t) for t in texts]
    for f in (pieces.encode, pieces.round_trip):
        assert f(none, path).count() == 0
    assert pieces.decode(pieces.encode(none, path), path).count() == 0


@pytest.mark.parametrize("f", [pieces.encode, pieces.round_trip])
def test_a_batch_is_not_held_as_texts_at_once(spark, f):
    import tracemalloc

    import pyarrow as pa
    from sentencepiece import SentencePieceProcessor

    class Docs:
        select = lambda self, *_: self
        mapInArrow = lambda self, run, _: run

    path = public_tokenizers.path("piece_bpe_32k.model")
    text = "of the same few words, и слова " * 500
    texts = [None, "", *[f"{i} {text}" for i in range(1000)], "漢" * 1000, None]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    want, size = SentencePieceProcessor(model_file=path).encode(texts[500]), batch.nbytes
    few = [t or "" for t in (*texts[:3], *texts[-2:])]
    del texts
    run = f(Docs(), path)
    pieces.encoder(path)
    tracemalloc.start()
    try:
        got = [(o.column("doc_id").to_pylist(), o.column("ids")) for o in run(iter([batch]))]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [k for keys, _ in got for k in keys] == list(range(1004))
    ids = [i for _, part in got for i in part]
    assert ids[500].as_py() == want and [pieces.Decoder(path).decode(np.array(ids[k].as_py(), int)) for k in (0, 1, 2, -2, -1)] == few
    assert size > 15_000_000 and peak < 2 * size, (size, peak)  # all texts at once are 31 MB, with their words 79


def test_pairs_met_again_are_answered_at_once(monkeypatch):
    path = public_tokenizers.path("piece_bpe_32k.model")
    enc, r = pieces.Encoder(path), np.random.default_rng(4)
    a, b = (r.choice(enc.pieces[enc.lengths < 5], 500) for _ in range(2))
    a[:3], b[2:5] = (-1, -2, -1), -1
    want = [x >= 0 and y >= 0 and enc.vocabulary.follows(x, y) for x, y in zip(a.tolist(), b.tolist())]
    assert enc._may_follow(a, b).tolist() == want and 0 < sum(want) < 495
    monkeypatch.setattr(pieces, "RECENT_PAIRS", 4)  # pairs push each other out
    assert pieces.Encoder(path)._may_follow(a, b).tolist() == want
    monkeypatch.undo()
    enc.pairs.clear()
    again = []
    monkeypatch.setattr(enc.vocabulary, "follows", lambda x, y: again.append((x, y)) or (x, y) in {(i, j) for i, j, w in zip(a.tolist(), b.tolist(), want) if w})
    assert enc._may_follow(a, b).tolist() == want and len(again) < 10


def test_suffix_array_orders_suffixes():
    codes = np.frombuffer("mississippi$banana$ananas$".encode("utf-32-le"), np.uint32)
    order = pieces.suffix_array(codes, 8).tolist()
    key = [tuple(codes[i : i + 8].tolist()) for i in order]
    assert key == sorted(key)


# --- decontamination -----------------------------------------------------------------------------


def brute_hits(rows, items, k=10):
    wins = {}
    for item, t in items:
        w = words(t)
        for i in range(max(1, len(w) - k + 1) if w else 0):
            wins.setdefault(tuple(w[i : i + k]), set()).add(item if item is None else str(item))
    out = []
    for d, t in rows:
        w, found = words(t), set()
        hit = bytearray(len(w))
        for n in {len(x) for x in wins}:
            for i in range(len(w) - n + 1):
                if (key := tuple(w[i : i + n])) in wins:
                    hit[i : i + n] = b"\1" * n
                    found |= wins[key]
        out.append((d, len(w), sum(hit), len(found), hashlib.sha256(",".join(sorted(x for x in found if x is not None)).encode()).hexdigest(), sum(hit) > 0))
    return sorted(out, key=repr)


ITEMS = [(1, SHARED), (2, "Two, three"), (3, None), (4, ""), (5, "漢 é"), (20, " ".join(SHARED.split()[5:20])), (1, "license"), (None, "one"), (6, "word word")]


@pytest.mark.parametrize("block", [1 << 20, 200])
def test_hits_equal_brute_force(spark, docs, block):
    bench = spark.createDataFrame([(i, t, 0) for i, t in ITEMS], "item_id long, text string, hits int")
    got = decontaminate.mark(docs, bench, block_states=block)
    want = brute_hits(DOCS, ITEMS)
    assert pairs(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == want
    texts = {d: t for d, t in DOCS}
    for r in got.where("n_hit > 0 and doc_id <> 14").collect():
        raw = texts[r.doc_id].encode()
        assert sum(len(words(raw[s.begin : s.end].decode())) for s in r.spans) == r.n_hit
    clean = decontaminate.keep_clean(docs, bench, block_states=block)
    assert sorted((r.doc_id for r in clean.collect()), key=repr) == sorted((w[0] for w in want if not w[5]), key=repr) and clean.columns == docs.columns


def test_empty_benchmark_and_documents(spark, docs, none):
    bench = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert not any(r.contaminated for r in decontaminate.mark(docs, bench.where("item_id = 0")).collect())
    assert decontaminate.mark(none, bench).count() == 0


# --- pages ---------------------------------------------------------------------------------------

ARTICLE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href="/">Home</a></li></ul></nav><!-- ad --><div class="ad banner">Buy!</div><article><h1>A &amp; B</h1><p><b>First   one,
with\tmarkup.<br><p>Second, &quot;quoted&quot;.</p><form><input>Send</form><div id="comments">Nice one, really.</div></article><aside>More</aside><footer>&copy; x</footer></body></html>"""
PLAIN = "<html><body><div class='menu'>a b c</div><div><p>" + prose(40, 1) + ", and.</p><p>short</p><p>" + prose(40, 2) + ".</p></div><div class='footer'>z</div></body></html>"


def test_articles():
    assert html_extract.extract(ARTICLE) == 'A & B\nFirst one, with markup.\nSecond, "quoted".'
    assert html_extract.extract(PLAIN) == f"{prose(40, 1)}, and.\nshort\n{prose(40, 2)}."
    for empty in (None, "", "<html></html>", "<script>x</script>", "<p"):
        assert html_extract.extract(empty) in ("", "<p")


def test_pages_keep_every_row(spark):
    p = spark.createDataFrame([(1, "u", ARTICLE, 1), (1, "u", ARTICLE, 1), (None, None, None, 2)], "page_id long, url string, html string, text int")
    got = html_extract.extract_pages(p)
    assert got.count() == 3 and pairs(got, "page_id", "n_chars")[-1] == (None, 0) and html_extract.extract_pages(p.where("page_id = 9")).count() == 0


# --- licenses ------------------------------------------------------------------------------------


def brute_base(t):
    w, places, labels = words(t), [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_places_equal_brute_force(docs):
    got = licenses.scan(docs)
    assert pairs(got, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == sorted(((d, *brute_base(t)) for d, t in DOCS), key=repr)


def brute_labels(t, k=5, near=8):
    """Labels and best share by comparing all pairs of positions, as the operator's text states the rule."""
    w, spans = words(t), []
    for label, template, needs in licenses.TEMPLATES:
        m = words(template)
        need = [{j for j in range(len(m) - k + 1) if f" {' '.join(words(p))} " in f" {' '.join(m[j : j + k])} "} for p in needs]
        by = {}
        for i in range(len(w) - k + 1):
            for j in range(len(m) - k + 1):
                if w[i : i + k] == m[j : j + k]:
                    by.setdefault(i - j, []).append((i, j))
        runs, before = [], None
        for d in sorted(by):
            first = min(i for i, _ in by[d])
            if before is None or d - before[0] > near or first - before[1] > 2 * len(m):
                runs.append([])
            runs[-1] += by[d]
            before = d, first
        for run in runs:
            a, b = min(i for i, _ in run), max(i for i, _ in run) + k - 1
            n = len({j + x for _, j in run for x in range(k)})
            if 2 * n >= len(m) and 2 * n >= b - a + 1 and all(g & {j for _, j in run} for g in need):
                spans.append((len(m) - n + (b - a + 1 - n) - n, label, a, b, n / len(m)))
    kept = []
    for s in sorted(spans):
        if all(s[3] < o[2] or o[3] < s[2] for o in kept):
            kept.append(s)
    return {s[1] for s in kept}, max((s[4] for s in kept), default=0.0)


OF = {t.label: t.text for t in licenses.TEMPLATES[::-1]}
MIT, NOTICE = OF["mit"], "This work is licensed under the Creative Commons {} 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/{}/4.0/"
GNU = "This {0} is free software; you can redistribute it and/or modify it under the terms of the GNU {1} License as published by the Free Software Foundation{2}. This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} License for more details."
BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
#: Texts and the labels that a reader would give them.
NAMED = [
    (MIT, "mit"), ("x y z " + MIT.upper() + " tail", "mit"), (" ".join(MIT.split()[:40] + ["new", "words"] + MIT.split()[40:]), "mit"), (" ".join(MIT.split()[:20]), ""), (prose(80, 3), ""), (OF["gpl"], "gpl"), (OF["bsd-2"], "bsd-2"), (OF["apache-2"], "apache-2"),
    (NOTICE.format("Attribution", "by"), "cc-by"), (NOTICE.format("Attribution-NonCommercial", "by-nc"), "cc-by-nc"), (NOTICE.format("Attribution-ShareAlike", "by-sa"), "cc-by-sa"), (NOTICE.format("Attribution-NoDerivatives", "by-nd"), "cc-by-nd"), (NOTICE.format("Attribution-NonCommercial-ShareAlike", "by-nc-sa"), "cc-by-nc-sa"),
    (NOTICE.format("Attribution-NonCommercial-NoDerivatives", "by-nc-nd"), "cc-by-nc-nd"), (f"{prose(30, 4)} {NOTICE.format('Attribution', 'by')} {prose(90, 5)} {NOTICE.format('Attribution-NonCommercial', 'by-nc')}", "cc-by,cc-by-nc"), (f"{NOTICE.format('Attribution', 'by')} {MIT}", "cc-by,mit"), ("Under the MIT license. " + NOTICE.format("Attribution-ShareAlike", "by-sa"), "cc-by-sa,mit"),
    (GNU.format("program", "General Public", "; either version 2 of the License, or (at your option) any later version"), "gpl-2"), (GNU.format("program", "General Public", ", either version 3 of the License, or (at your option) any later version"), "gpl-3"),
    (GNU.format("program", "Affero General Public", ", either version 3 of the License, or (at your option) any later version"), "agpl-3"), (GNU.format("library", "Lesser General Public", "; either version 2.1 of the License, or (at your option) any later version"), "lgpl-2.1"),
    (GNU.format("library", "Lesser General Public", "; either version 3 of the License, or (at your option) any later version"), "lgpl-3"), (GNU.format("program", "General Public", ""), "gpl"), (GNU.format("program", "Affero General Public", ""), ""), (GNU.format("program", "Frobnicated General Public", ", either version 3 of the License, or (at your option) any later version"), ""),
    (BSD, "bsd-2"), (BSD + " Neither the name of the University nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.", "bsd-3"),
    ("Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. The software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness.", "isc"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. The software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness.", ""),
    ("To the extent possible under law, Jane Doe has waived all copyright and related or neighboring rights to this work.", "cc0"), ("This text is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.", "cc-by-nc-nd"),
    ("Licensed under a Creative Commons Attribution 3.0 Unported License", "cc-by"), ("licensed under a Creative Commons Attribution-Frob 4.0 International License", ""), ("licensed under the creative commons attribution", ""), (None, ""), ("", ""),
]


def test_labels_are_those_a_reader_gives(spark, none):
    d = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(NAMED)], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(d).collect()}
    assert [got[i].labels for i in range(len(NAMED))] == [want for _, want in NAMED]
    for i, (t, _) in enumerate(NAMED):
        labels, share = brute_labels(t)
        assert got[i].labels == ",".join(sorted(labels | set(filter(None, got[i].base_labels.split(",")))))
        assert got[i].score == pytest.approx(1.0 if got[i].n_base else share)
    assert licenses.scan(none).count() == 0


def test_rivals_equal_brute_force(spark):
    import random

    r = random.Random(8)
    texts = []
    for _ in range(40):
        w = [x for _ in range(r.randint(1, 3)) for x in r.choice(licenses.TEMPLATES).text.split() + prose(r.randint(0, 30), r.randint(0, 99)).split()]
        texts.append(" ".join(x for x in w for x in ([x] if r.random() < 0.97 else r.choice([[], [x, "new"], ["other"]]))))
    got = {x.doc_id: x for x in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        labels, share = brute_labels(t)
        assert got[i].labels == ",".join(sorted(labels | set(filter(None, got[i].base_labels.split(",")))))
        assert got[i].score == pytest.approx(1.0 if got[i].n_base else share)
