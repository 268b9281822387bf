"""Operators that treat rows on their own: round trips and brute force."""

from __future__ import annotations

import gzip
import hashlib
import io
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardlens.llm import bpe, language, licenses, pii, token_counts, token_files, warc
from wardlens.llm.common import Workspace
from wardlens.llm.tokens import rank_encoding

ODD = [" ", "  ", "\n", " \n", "\t", "a", "Zé", "!", "'s", " '", " ", "　", "\x1c", "\x85",
       "12", "日本", "👍", ".", " —", "\r\n", "<|endoftext|>", "it's"]


def _texts(n=400):
    rng = random.Random(2)
    return [None, "", " ", "  "] + ["".join(rng.choice(ODD) for _ in range(rng.randrange(1, 50)))
                                    for _ in range(n)] + ["word " * 30000, "a" * 20000]


def _docs(spark, texts):
    rows = [(i, t, "n", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, block int").repartition(4)


def test_bpe_equals_library_and_decodes(spark):
    texts = _texts()
    reference = rank_encoding(bpe.RANKS, bpe.PATTERN)
    rows = bpe.digests(bpe.encode(_docs(spark, texts))).collect()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows}
    for i, text in enumerate(texts):
        ids = np.array(reference.encode_ordinary(text or ""), "<u4")
        assert got[i] == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                          hashlib.sha256((text or "").encode()).hexdigest()), repr(text)


def test_bpe_repeated_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    rows = bpe.decode(bpe.encode(docs)).collect()
    assert sorted((r.doc_id or 0, bytes(r.decoded)) for r in rows) == [(0, b"c"), (1, b"a b"), (1, b"a b")]
    assert bpe.digests(bpe.encode(docs.limit(0))).count() == 0


@pytest.mark.parametrize("plain", [False, True])
def test_token_files(spark, plain):
    from tokenizers import Tokenizer
    texts = [*_texts(), "a <|endoftext|> b", "x<|endoftext|>", "<|endoftext|> <|endoftext|>."]
    tokenizer = Tokenizer.from_file(token_files.TOKENIZER)
    if plain:
        tokenizer.encode_special_tokens = True
    path = Workspace(spark, "test").path("tokens")
    token_files.write_tokens(_docs(spark, texts), path, plain=plain)
    rows = token_files.with_starts(token_files.checksums(token_files.read_tokens(spark, path)),
                                   token_files.read_tokens(spark, path, ["part", "n_tokens"])).collect()
    got, start = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows}, 0
    for i, text in enumerate(texts):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        assert got[i] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    one = token_files.read_tokens(spark, path, ["doc_id", "ids"], ids=[5])
    assert "EqualTo(doc_id,5)" in one._jdf.queryExecution().toString()
    assert one.columns == ["doc_id", "ids"] and one.count() == 1


def test_token_files_footers(spark):
    """Delta encodings, a page index and small row groups are in the files."""
    import glob

    import pyarrow.parquet as pq
    path = Workspace(spark, "test").path("tokens")
    docs = spark.range(20000).selectExpr("id AS doc_id", "concat('word', id, ' and ', id * 7) AS text")
    token_files.write_tokens(docs, path, **{"parquet.block.size": str(64 << 10)})
    files = [pq.ParquetFile(f) for f in glob.glob(f"{path.removeprefix('file:')}/*.parquet")]
    columns = {}
    groups = 0
    for f in files:
        groups = max(groups, f.metadata.num_row_groups)
        for g in range(f.metadata.num_row_groups):
            for c in range(f.metadata.num_columns):
                column = f.metadata.row_group(g).column(c)
                columns.setdefault(column.path_in_schema, set()).update(column.encodings)
                assert column.has_offset_index and column.has_column_index
    assert groups > 1
    assert any("DELTA_BINARY_PACKED" in columns[c] for c in ("doc_id", "row"))


def test_token_files_odd_rows(spark):
    path = Workspace(spark, "test").path("tokens")
    schema = "doc_id long, text string"
    token_files.write_tokens(spark.createDataFrame([(2, "a"), (None, "b"), (2, "a"), (2, None)], schema), path)
    rows = token_files.with_starts(token_files.checksums(token_files.read_tokens(spark, path)),
                                   token_files.read_tokens(spark, path, ["part", "n_tokens"]))
    assert [(r.doc_id, r.start, r.n_tokens) for r in rows.orderBy("start").collect()] == [
        (None, 0, 2), (2, 2, 1), (2, 3, 2), (2, 5, 2)]
    empty = Workspace(spark, "test").path("tokens")
    token_files.write_tokens(spark.createDataFrame([], schema), empty)
    assert token_files.checksums(token_files.read_tokens(spark, empty)).count() == 0


def _brute_pages(pages):
    out = []
    for page_id, html in pages:
        body = (html or "").encode()
        top = max((p for p, h in pages if p is not None and (h or "") == (html or "")), default=None)
        visit = len(body) >= 1000 and page_id is not None and page_id < top
        out.append((page_id, len(body), hashlib.sha1(body).hexdigest(),
                    "revisit" if visit else "response", top if visit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("split", [100, 5000, 1 << 20])
def test_warc_round_trip(spark, split):
    rng = random.Random(8)
    inner = gzip.compress(b"WARC/1.1 is not here").decode("latin1")
    bodies = [None, "", "é" * 600, "x" * 1000, "y" * 999, "\r\n\r\n" * 300, inner * 50,
              "".join(chr(rng.randrange(32, 1000)) for _ in range(200_000))]
    pages = [(i, bodies[i % len(bodies)]) for i in range(40)] + [
        (None, "x" * 1000), (39, "x" * 1000), (3, "x" * 1000), (3, "x" * 1000)]
    frame = spark.createDataFrame([(p, "http://a/\n" if p else None, h, "c") for p, h in pages],
                                  "page_id long, url string, html string, digest string").repartition(3)
    work = Workspace(spark, "test")
    written = warc.write_archives(frame, work)
    read = warc.read_archives(written, work.path("archives"), split, keep_payload=True).collect()
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                  for r in read), key=repr)
    assert got == _brute_pages(pages)
    assert all(hashlib.sha1(r.payload).hexdigest() == r.payload_digest
               for r in read if r.record_type == "response")


def test_warc_members_are_plain_gzip_and_empty_table(spark):
    data = warc.record(4, "http://a", b"hello", None) + warc.record(5, "http://b", b"z" * 2000, 4)
    text = gzip.GzipFile(fileobj=io.BytesIO(data)).read()
    assert text.count(b"WARC/1.1\r\n") == 2 and b"WARC-Refers-To: <urn:wardlens:page:4>" in text
    work = Workspace(spark, "test")
    written = warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), work)
    assert warc.read_archives(written, work.path("archives")).count() == 0


class _Counting(io.BytesIO):
    count = 0

    def read(self, n=-1):
        data = super().read(n)
        self.count += len(data)
        return data


def _foreign(kind, body, *lines, http=True):
    head = ["WARC/1.0", f"WARC-Type: {kind}", "WARC-Date: 2026-01-01T00:00:00Z", *lines,
            f"Content-Length: {len(body)}"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n")


def _foreign_archive():
    page = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n<html>hi</html>"
    http = "Content-Type: application/http; msgtype=response"
    sha = hashlib.sha1(b"<html>hi</html>")
    return [
        _foreign("warcinfo", b"software: x\r\n", "WARC-Record-ID: <urn:uuid:1>",
                 "Content-Type: application/warc-fields"),
        _foreign("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", "WARC-Record-ID: <urn:uuid:2>",
                 "Content-Type: application/http; msgtype=request"),
        _foreign("response", page, "WARC-Record-ID: <urn:uuid:3>", "WARC-Target-URI: http://a/", http),
        _foreign("response", page, "WARC-Record-ID: <urn:uuid:4>", http,
                 f"WARC-Payload-Digest: sha1:{sha.hexdigest()}"),
        _foreign("response", page, "WARC-Record-ID: <urn:uuid:5>", http, "WARC-Payload-Digest: md5:00"),
        _foreign("response", b"not http at all", "WARC-Record-ID: <urn:uuid:6>", http),
        _foreign("revisit", b"HTTP/1.1 200 OK\r\n\r\n", "WARC-Record-ID: <urn:uuid:7>", http,
                 "WARC-Refers-To: <urn:uuid:4>"),
        _foreign("resource", b"", "WARC-Target-URI: file://x"),
        _foreign("metadata", b"a: b\r\n\r\nmore", "WARC-Record-ID: <urn:uuid:8>"),
    ]


def test_warc_of_other_writers_split_anywhere():
    members = _foreign_archive()
    data = b"".join(members)
    whole = list(warc.records_in_range(io.BytesIO(data), len(data), 0, len(data), True))
    assert [r["record_type"] for r in whole] == ["warcinfo", "request", "response", "response", "response",
                                                 "response", "revisit", "resource", "metadata"]
    assert [r["payload"] for r in whole] == [
        b"software: x\r\n", b"", *[b"<html>hi</html>"] * 3, b"not http at all", None, b"",
        b"a: b\r\n\r\nmore"]
    assert whole[2]["payload_digest"] == hashlib.sha1(b"<html>hi</html>").hexdigest()
    assert whole[2]["url"] == "http://a/" and whole[2]["page_id"] is None
    assert (whole[6]["refers_to_id"], whole[6]["payload_digest"]) == ("urn:uuid:4", None)
    assert whole[7]["record_id"] is None and whole[8]["record_id"] == "urn:uuid:8"
    for cut in range(1, len(data)):
        parts = [list(warc.records_in_range(io.BytesIO(data), len(data), a, b, True))
                 for a, b in ((0, cut), (cut, len(data)))]
        assert parts[0] + parts[1] == whole, cut
    bad = _foreign("response", b"HTTP/1.1 200 OK\r\n\r\nx", "WARC-Record-ID: <urn:uuid:9>",
                   "Content-Type: application/http", f"WARC-Payload-Digest: sha1:{'0' * 40}")
    with pytest.raises(ValueError, match="does not match"):
        list(warc.records_in_range(io.BytesIO(bad), len(bad), 0, len(bad)))
    with pytest.raises(EOFError):
        list(warc.records_in_range(io.BytesIO(bad[:-9]), len(bad) - 9, 0, len(bad) - 9))


def test_warc_is_read_about_once():
    rng = random.Random(3)
    data = b"".join(warc.record(i, None, rng.randbytes(rng.randrange(9000)), None) for i in range(3000))
    assert len(data) > 4 << 20
    total = count = 0
    for start in range(0, len(data), 4 << 20):
        source = _Counting(data)
        count += sum(1 for _ in warc.records_in_range(source, len(data), start,
                                                      min(start + (4 << 20), len(data))))
        total += source.count
    assert count == 3000 and total < 1.5 * len(data)


def test_markup_without_ends_takes_linear_time():
    import time
    assert language.markup_text("a<!-- x -->b<script>no</SCRIPT >c<p class=1>d &amp; e<") == "a b c d & e<"
    assert language.markup_text("<style>x</style>y<!-- open <i>z</i>") == " y z "
    def seconds(n):
        start = time.process_time()
        language.markup_text("<!--" * n + "<script>" * n + "<" * n)
        return time.process_time() - start
    seconds(1000)
    assert seconds(100_000) < 5


def _brute_feistel(key, kind, left, right, a, b):
    for i in range(1, pii.ROUNDS + 1):
        half, size = (right, a) if i % 2 else (left, b)
        value = int(hashlib.sha256(f"{key}|{kind}|{i}|{half}".encode()).hexdigest()[:15], 16) % size
        left, right = ((left + value) % a, right) if i % 2 else (left, (right + value) % b)
    return left, right


def _luhn(digits):
    return sum(sum(divmod(int(d) * 2, 10)) if i % 2 else int(d)
               for i, d in enumerate(reversed(digits))) % 10 == 0


def test_pii(spark):
    texts = ["card 4532015112830366 and 4532-0151-1283-0366, not 4532015112830367!!", "+1 (487) 555-7209",
             "net 97.51.17.173 not 300.1.1.1 or v1.2.3", "A the.72@mail3.example.com%%% B", "123-45-6789 000-12-3456",
             "on 2024-02-29, 2023-02-29, 12/31/1999 31.12.1999.", None, "", "plain words, 2.0 and 1234567",
             "x" * 100_000 + " 4532015112830366", "4532015112830366"]
    frame = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, n_card string")
    made = pii.pseudonymise(frame)
    rows = {r.doc_id: r for r in made.collect()}
    left, right = _brute_feistel(pii.KEY, "card", 4532015, 11283036, 10 ** 7, 10 ** 8)
    body = f"{left:07d}{right:08d}"
    card = next(body + str(c) for c in range(10) if _luhn(body + str(c)))
    dashed = "-".join(card[i:i + 4] for i in range(0, 16, 4))
    assert rows[0].text == f"card {card} and {dashed}, not 4532015112830367!!" and rows[0].n_card == 2
    assert rows[10].text == card and rows[9].text == "x" * 100_000 + " " + card
    l, r = _brute_feistel(pii.KEY, "phone", 287 * 800 + 355, 7209, 640_000, 10_000)
    phone = f"{l // 800 + 200:03d}{l % 800 + 200:03d}{r:04d}"
    assert rows[1].text == f"+1 ({phone[:3]}) {phone[3:6]}-{phone[6:]}"
    l, r = _brute_feistel(pii.KEY, "ip", 97 * 256 + 51, 17 * 256 + 173, 65536, 65536)
    assert rows[2].text == f"net {l // 256}.{l % 256}.{r // 256}.{r % 256} not 300.1.1.1 or v1.2.3"
    assert re.fullmatch(r"A p[0-9a-f]{16}@mail\.invalid%%% B", rows[3].text)
    assert rows[4].n_ssn == 1 and rows[4].text.endswith(" 000-12-3456")
    assert rows[5].n_date == 3 and " 2023-02-29, " in rows[5].text
    assert [rows[i].text for i in (6, 7, 8)] == [texts[i] for i in (6, 7, 8)]
    path = Workspace(spark, "test").path("made")
    made.write.parquet(path)
    back = {r.doc_id: r.text for r in pii.restore(spark.read.parquet(path)).collect()}
    assert all(back[i] == t for i, t in enumerate(texts) if i != 3)


def test_feistel_is_a_permutation(spark):
    moved = pii.feistel("k", F.lit("date"), F.floor(F.col("id") / 7), F.pmod("id", F.lit(7)),
                        F.lit(5), F.lit(7))
    small = spark.range(35).select(moved.alias("p"))
    pairs = {(r.p.l, r.p.r) for r in small.collect()}
    assert pairs == {(i, j) for i in range(5) for j in range(7)}


def test_licenses(spark):
    mit = ("MIT License\nPermission is hereby granted, free of charge, to any person obtaining a copy of this "
           "software and so on.\nThe above copyright notice and this permission notice shall be included in "
           "all copies.\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED.")
    texts = ["Foo bar.\nReleased under the MIT License. More.", "Licensed under the Apache License, Version 2.0.",
             "This work is licensed under the GNU General Public License, version 3.\nLicensed under CC BY-NC 4.0.",
             mit, "All rights reserved.\nAll rights reserved.", "Get your driving licence here!", None, "", "x " * 50_000,
             "LICENSED   UNDER THE APACHE LICENSE, VERSION 2.0. You may not use this file except in compliance with the License."]
    frame = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, found string")
    got = {r.doc_id: (r.licenses, r.n_matches, r.n_unknown) for r in licenses.recognise(frame).collect()}
    assert got == {0: (["MIT"], 1, 0), 1: (["Apache-2.0"], 1, 0), 2: (["GPL-3.0", "CC-BY-NC-4.0"], 2, 0),
                   3: (["MIT"], 1, 0), 4: (["All-Rights-Reserved"], 2, 0), 5: ([], 0, 1), 6: ([], 0, 0),
                   7: ([], 0, 0), 8: ([], 0, 0), 9: (["Apache-2.0"], 1, 0)}


def test_token_counts_and_ledger(spark):
    texts = _texts(100)
    docs = [(i, t, f"s{i % 3}" if i % 7 else None, "en") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string")
    reference = rank_encoding(token_counts.RANKS, token_counts.PATTERN)
    counts = token_counts.count_tokens(frame)
    assert {r.doc_id: r.n_tokens for r in counts.collect()} == {
        i: len(reference.encode_ordinary(t or "")) for i, t in enumerate(texts)}
    ledger = token_counts.Ledger(spark, Workspace(spark, "test").path("ledger"))
    assert ledger.totals().count() == 0

    def totals():
        return {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in ledger.totals().collect()}

    def want(rows):
        out = {}
        for _, text, source, lang in rows:
            n, t = out.get((source, lang, "byte_bpe_50k"), (0, 0))
            out[(source, lang, "byte_bpe_50k")] = (n + 1, t + len(reference.encode_ordinary(text or "")))
        return out

    assert ledger.commit("b1", token_counts.inserts(counts))
    assert not ledger.commit("b1", token_counts.inserts(counts))
    assert totals() == want(docs)
    gone = counts.where("doc_id % 3 = 1")
    assert ledger.commit("b2", token_counts.deletes(gone))
    old = counts.where("doc_id = 6")
    new = old.withColumn("n_tokens", F.col("n_tokens") + 5)
    assert ledger.commit("b3", token_counts.revisions(old, new))
    assert ledger.commit("b4", token_counts.inserts(counts.limit(0)))
    expected = want([d for d in docs if d[0] % 3 != 1])
    key = (docs[6][2], "en", "byte_bpe_50k")
    expected[key] = (expected[key][0], expected[key][1] + 5)
    assert totals() == expected
    with pytest.raises(ValueError):
        ledger.commit("../b5", token_counts.inserts(counts))


def test_ledger_compaction_and_two_committers(spark, monkeypatch):
    path = Workspace(spark, "test").path("ledger")
    one, two = token_counts.Ledger(spark, path), token_counts.Ledger(spark, path)
    counts = spark.createDataFrame([(i, "s", None, "t", i, "clash") for i in range(9)],
                                   "doc_id long, source string, lang string, tokenizer string, n_tokens long, sign string")
    for i in range(3):
        assert one.commit(f"b{i}", token_counts.inserts(counts.where(f"doc_id % 3 = {i}")))
    want = [("s", None, "t", 9, 36)]
    for _ in range(2):
        one.compact()
        assert [tuple(r) for r in two.totals().collect()] == want
        assert len({f for f in one.table.parts().values() if f}) == 1
    assert not two.commit("b1", token_counts.inserts(counts)) and one.is_committed("b2")
    write = token_counts.Ledger._write

    def slow(ledger, rows):
        folder = write(ledger, rows)
        if ledger is one:  # another committer of the batch is faster
            assert two.commit("b9", token_counts.deletes(counts.where("doc_id = 8")))
        return folder

    monkeypatch.setattr(token_counts.Ledger, "_write", slow)
    assert not one.commit("b9", token_counts.deletes(counts.where("doc_id = 8")))
    assert [tuple(r) for r in one.totals().collect()] == [("s", None, "t", 8, 28)]


SF = "/root/testdata/sf0.001"


def test_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit(docs, sample=20)
    evidence = language.text_evidence(docs, model, "doc_id", F.col("text"), F.lit(None).cast("string"),
                                      F.lit(None).cast("string"))
    got = {r.key: r.lang for r in language.identify(evidence, model, Workspace(spark, "test")).collect()}
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert sum(got[i] == truth[i] for i in truth) / len(truth) > 0.97


def test_language_evidence_and_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit(docs, sample=20)
    rows = [(1, None, "fr", "a.fr"), (2, "", None, None), (3, "123 !!", "de", "x"), (4, "o", "fr", "b.fr"),
            (5, "qzx jqk vwx zzq xqj kqz wvx " * 30, None, None), (None, "the and of with", "en", "c.com"),
            (4, "o", "fr", "b.fr"), (6, "the of and that with " * 5000, None, "c.com")]
    frame = spark.createDataFrame(rows, "k long, t string, d string, scores string")
    evidence = language.text_evidence(frame, model, "k", F.col("t"), F.col("d"), F.col("scores"))
    out = language.identify(evidence, model, Workspace(spark, "test")).collect()
    got = {r.key: r.lang for r in out}
    assert len(out) == len(rows)
    assert [got[i] for i in (1, 2, 3, 5)] == ["und"] * 4
    assert got[4] == "fr" and got[6] == "en"
    assert all(0 <= r.confidence <= 1 for r in out)
    none = language.text_evidence(frame.limit(0), model, "k", F.col("t"), F.col("d"), F.col("scores"))
    assert language.identify(none, model, Workspace(spark, "test")).count() == 0
    assert language.fit(docs.limit(0)).languages == ["und"]


def test_markup():
    text = language.markup_text("<p>a&amp;b<script>var t='</p>'</script><!-- x --> c</p>")
    assert text.split() == ["a&b", "c"]


MIT_TEXT = """MIT License

Copyright (c) 2021 Jane Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
BSD_TEXT = """Copyright (c) 2021, Jane Doe
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED."""
GPL_TEXT = """This program is free software{} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""


def _marked(text, mark):
    return "\n".join(f"{mark} {line}".rstrip() for line in text.split("\n"))


def _licenses(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in licenses.recognise(frame).collect()}


def test_licenses_of_wrapped_texts(spark):
    whole = [(MIT_TEXT, ["MIT"]), (BSD_TEXT, ["All-Rights-Reserved", "BSD-3-Clause"]),
             (BSD_TEXT.replace("\n\n3. Neither", "\n\nNo").replace("All rights reserved.", ""), ["BSD-2-Clause"]),
             (GPL_TEXT.format(":"), ["GPL-3.0-or-later"]), (GPL_TEXT.format(";"), ["GPL-3.0-or-later"])]
    cases = [(f(text), want) for text, want in whole for f in (
        str, lambda t: t.replace("\n", "\r\n"), lambda t: "/*\n" + _marked(t, " *") + "\n */\nint main() {}",
        lambda t: _marked(t, "#"), lambda t: _marked(t, "//"), lambda t: _marked(t, "dnl"),
        lambda t: re.sub(r"(?<!\n)(?<!Doe)\n(?!\n)", " ", t))]
    # A list without blank lines, an unknown sentence between two known ones, a
    # notice on a line of its own among other text, in a wrapped line, and cut by a blank one.
    cases += [(re.sub(r"\n+", "\n", BSD_TEXT), ["All-Rights-Reserved", "BSD-3-Clause"]),
              (MIT_TEXT.replace("THE SOFTWARE IS", "Keep this notice with the files.\n\nTHE SOFTWARE IS"), ["MIT"]),
              ("Some words\nLicensed under CC BY-NC 4.0\nand more words", ["CC-BY-NC-4.0"]),
              ("This small tool is\nlicensed under the\nMIT License\n", ["MIT"]),
              ("licensed under the\n\nMIT Licence for fishing", []),
              ("\n" * 100_000 + "https://a/license" + " \n" * 100_000 + ". " * 50_000, [])]
    got = _licenses(spark, [text for text, _ in cases])
    assert [(i, got[i].licenses) for i in range(len(cases))] == [(i, want) for i, (_, want) in enumerate(cases)]
    assert got[0].n_matches == 1 and got[0].n_unknown == 0


APACHE_TEXT = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""


def test_notices_of_further_licences(spark):
    gnu = ("This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser "
           "General Public\nLicense as published by the Free Software Foundation; either\nversion {} of the License, or "
           "(at your option) any later version.")
    later = GPL_TEXT.format(";").replace("version 3", "version 2")
    isc = ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is "
           "hereby granted{}.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES.")
    commons = "This work is licensed under a Creative Commons {} 4.0 International License."
    cases = [
        (gnu.format("2.1"), "LGPL-2.1-or-later"), (gnu.format("3"), "LGPL-3.0-or-later"),
        (later, "GPL-2.0-or-later"),
        (GPL_TEXT.format(":").replace("GNU General", "GNU Affero General"), "AGPL-3.0-or-later"),
        (GPL_TEXT.format(":").replace("either version 3 of the License, or\n(at your option) any later version", "v9"), "GPL"),
        ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL "
         "was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.", "MPL-2.0"),
        (isc.format(", provided that the above\ncopyright notice and this permission notice appear in all copies"), "ISC"),
        (isc.format(""), "0BSD"),
        ("This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy.", "Unlicense"),
        (commons.format("Attribution"), "CC-BY-4.0"), (commons.format("Attribution-ShareAlike"), "CC-BY-SA-4.0"),
        (commons.format("Attribution-NonCommercial-NoDerivatives"), "CC-BY-NC-ND-4.0"),
        (commons.format("Attribution-NonCommercial"), "CC-BY-NC-4.0"),
        ("licensed under the Apache License, Version 2.0 and the MIT license", "Apache-2.0 AND MIT"),
        ("Licensed under either of the Apache License, Version 2.0 or the MIT license.", "Apache-2.0 OR MIT"),
        *[(f"{mark} SPDX-License-Identifier: {i}{end}\nint x;", i) for i in licenses.SPDX
          for mark, end in (("//", ""), ("/*", " */"), ("#", ""))],
        ("SPDX-License-Identifier: LicenseRef-own", None),
    ]
    got = _licenses(spark, [text for text, _ in cases])
    for i, (text, want) in enumerate(cases):
        assert got[i].licenses == ([want] if want else []), (text, got[i])


def test_licenses_of_odd_tables(spark):
    frame = spark.createDataFrame([(1, "All rights reserved.", "x", 1)] * 3 + [(None, None, None, None)],
                                  "doc_id long, text string, found string, n_matches int")
    rows = licenses.recognise(frame).collect()
    assert sorted((r.doc_id or 0, r.n_matches) for r in rows) == [(0, 0), (1, 1), (1, 1), (1, 1)]
    assert licenses.recognise(frame.limit(0)).count() == 0
    made = pii.pseudonymise(frame)
    assert made.count() == 4 and pii.pseudonymise(frame.limit(0)).count() == 0


def test_canonical_apache_header(spark):
    curly = APACHE_TEXT.replace('"License"', "\u201cLicense\u201d")
    texts = [APACHE_TEXT, curly, _marked(APACHE_TEXT, "#"), "/*\n" + _marked(APACHE_TEXT, " *") + "\n */\nclass A {}",
             _marked(APACHE_TEXT, "//"), APACHE_TEXT.replace("\n", "\r\n"), re.sub(r"(?<!\n)\n(?!\n)", " ", APACHE_TEXT)]
    for row in _licenses(spark, texts).values():
        assert row.licenses == ["Apache-2.0"] and row.n_matches == 1
        assert row.sentence_ids[:4] == ["apache2-licensed", "apache2-comply", "apache2-copy", "apache2-asis"]


PII_LAYOUTS = {
    "phone": ["+14155552671", "+1 415 555 2671", "415 555 2671", "+49 30 1234567", "+33 1 23 45 67 89", "+1(415)555-2671",
              "(415) 555 2671", "+44 (0)20 7946 0958", "+4930123456789", "+683 4002", "+420 601 123 456", "415.555.2671"],
    "date": ["2024-01-02T10:00:00Z", "31-12-1999", "31/12/1999", "12-31-1999", "12/31/1999", "29.02.2024", "13/01/1800",
             "31/12/2199", "2024/01/02T10:00"],
    "card": ["3782 822463 10005", "3782-822463-10005", "3056 930902 5904", "378282246310005"],
}


def test_pii_layouts(spark):
    values = [(kind, v) for kind, some in PII_LAYOUTS.items() for v in some]
    texts = [f"<{v}> and {v}, end" for _, v in values] + [
        "+1 415 555 2671 2024-01-02", "+49 30 1234567 31.12.1999", "100 200 2024-01-02", "+123456", "+1 23 4567",
        "+1234567890123456", "31/31/1999 30-02-1999 32.01.1999", "1999-31-12", "3782 822463 10006", "+" * 50_000 + "1 " * 50_000]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    path = Workspace(spark, "test").path("made")
    pii.pseudonymise(rows).write.parquet(path)
    made = {r.doc_id: r for r in spark.read.parquet(path).collect()}
    shape = lambda t: re.sub("[0-9]", "0", t)
    for i, (kind, value) in enumerate(values):
        assert [made[i][f"n_{k}"] for k in pii.KINDS] == [2 * (k == kind) for k in pii.KINDS], value
        new = re.fullmatch("<(.*)> and (.*), end", made[i].text)
        assert new[1] == new[2] != value and shape(new[1]) == shape(value)
    code = {"+49 30 1234567": "+49 ", "+4930123456789": "+49", "+683 4002": "+683 ", "+33 1 23 45 67 89": "+33 "}
    for i, (_, value) in enumerate(values):
        assert made[i].text.startswith("<" + code.get(value, "+1" if value.startswith("+1") else ""))
    n = len(values)
    assert [(made[i].n_phone, made[i].n_date) for i in (n, n + 1, n + 2)] == [(1, 1), (1, 1), (0, 1)]
    assert all(made[i].text == texts[i] for i in range(n + 3, len(texts)))
    back = pii.restore(spark.read.parquet(path)).collect()
    assert {r.doc_id: r.text for r in back} == dict(enumerate(texts))


def test_a_day_has_one_pseudonym_in_every_layout(spark):
    import datetime as dt
    rng = random.Random(6)
    days = [dt.date(1800, 1, 1) + dt.timedelta(days=rng.randrange(146_097)) for _ in range(150)]
    days += [dt.date(1999, 12, 31), dt.date(2000, 2, 29), dt.date(2199, 12, 31), dt.date(1800, 1, 1)]
    layouts = {"iso": "%Y-%m-%d", "points": "%d.%m.%Y", "slash": "%m/%d/%Y", "hyphen": "%d-%m-%Y"}
    other = {"turned slash": "%d/%m/%Y", "turned points": "%m.%d.%Y"}  # read so from the 13th on
    rows = [(i, k, d.strftime(f).zfill(10)) for i, d in enumerate(days)
            for k, f in (layouts | (other if d.day > 12 else {})).items()]
    frame = spark.createDataFrame(rows, "n int, layout string, text string")
    made = pii.pseudonymise(frame)
    path = Workspace(spark, "test").path("made")
    made.write.parquet(path)
    new = {}
    for r in spark.read.parquet(path).collect():
        assert r.n_date == 1
        moved = dt.datetime.strptime(r.text, (layouts | other)[r.layout]).date()
        assert new.setdefault(r.n, moved) == moved and (moved.day > 12) == (days[r.n].day > 12)
    assert len(set(new.values())) == len(set(days))
    back = {(r.n, r.layout): r.text for r in pii.restore(spark.read.parquet(path)).collect()}
    assert back == {(n, k): t for n, k, t in rows}


def test_phones_stay_in_their_plan(spark):
    rng = random.Random(7)
    numbers = sorted({f"{rng.choice(['(%03d) %03d-%04d', '+1 %03d %03d %04d', '%03d-%03d-%04d'])}"
                      % (rng.randrange(1000), rng.randrange(1000), rng.randrange(10_000)) for _ in range(300)})
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(numbers)], "n int, text string")
    path = Workspace(spark, "test").path("made")
    pii.pseudonymise(frame).write.parquet(path)
    made = {r.n: r for r in spark.read.parquet(path).collect()}
    def digits(text):
        return re.sub("[^0-9]", "", text)[-10:]
    for i, old in enumerate(numbers):
        assert made[i].n_phone == 1
        a, b = digits(old), digits(made[i].text)
        planned = a[0] in "23456789" and a[3] in "23456789"
        assert (b[0] in "23456789" and b[3] in "23456789") if planned else (b[0], b[3]) == (a[0], a[3])
        assert re.sub("[0-9]", "0", made[i].text) == re.sub("[0-9]", "0", old)
    pairs = {digits(numbers[i]): digits(made[i].text) for i in made}
    assert len(set(pairs.values())) == len(pairs)
    back = {r.n: r.text for r in pii.restore(spark.read.parquet(path)).collect()}
    assert back == dict(enumerate(numbers))


def test_early_days_are_numbered(spark):
    days = spark.sql("select explode(sequence(date'1800-01-01', date'2199-12-31')) as d").where("day(d) <= 12")
    got = days.select(pii._early_number(F.col("d")).alias("n"), "d").withColumn("back", pii._early_date(F.col("n")))
    total = pii._EARLY_LEFT * pii._EARLY_RIGHT
    assert got.where("back <> d").count() == 0
    assert got.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first()[:] == (0, total - 1, total)


def test_late_days_are_numbered(spark):
    days = spark.sql("select explode(sequence(date'1800-01-01', date'2199-12-31')) as d").where("day(d) > 12")
    got = days.select(pii._late_number(F.col("d")).alias("n"), "d").withColumn("back", pii._late_date(F.col("n")))
    row = got.agg(F.count("*"), F.min("n"), F.max("n"), F.countDistinct("n"), F.sum((F.col("back") == F.col("d")).cast("int")))
    total = pii._LATE_LEFT * pii._LATE_RIGHT
    assert tuple(row.first()) == (total, 0, total - 1, total, total)


def test_token_counts_query_commits_deletes_and_revisions(spark, monkeypatch):
    steps, commit = [], token_counts.Ledger.commit

    def noted(ledger, batch_id, changes):
        done = commit(ledger, batch_id, changes)
        signs = {r.sign for r in changes.select("sign").distinct().collect()}
        steps.append((batch_id, done, signs, ledger.totals().agg(F.sum("n_docs"), F.sum("n_tokens")).first()))
        return done

    monkeypatch.setattr(token_counts.Ledger, "commit", noted)
    got = {tuple(r) for r in token_counts.query(spark, SF).collect()}
    counts = token_counts.count_tokens(spark.read.parquet(f"{SF}/documents.parquet"))
    plain = counts.groupBy(*token_counts.GROUP).agg(F.count("*"), F.sum("n_tokens"))
    assert got == {tuple(r) for r in plain.collect()}
    assert [(b, done, signs) for b, done, signs, _ in steps] == [
        ("load-1", True, {1}), ("load-2", True, {1}), ("delete-1", True, {-1}), ("revise-1", True, {1, -1}),
        ("load-3", True, {1}), ("load-1", False, {1}), ("load-2", False, {1}), ("delete-1", False, {-1})]
    totals = [tuple(t) for *_, t in steps]
    n_docs, n_tokens = counts.agg(F.count("*"), F.sum("n_tokens")).first()
    assert totals[1][0] == n_docs and totals[1][1] > n_tokens and totals[2][0] < n_docs
    assert totals[3][0] == totals[2][0] and totals[3][1] < totals[2][1]
    assert totals[4:] == [(n_docs, n_tokens)] * 4


def test_bpe_decodes_in_the_workers_that_encode(spark):
    docs = _docs(spark, _texts(20))
    both, apart = bpe.encode(docs, decoded=True), bpe.decode(bpe.encode(docs))
    assert both.schema == apart.schema
    read = lambda df: sorted((r.doc_id, r.ids, bytes(r.decoded)) for r in df.collect())
    assert read(both) == read(apart)
    assert bpe.encode(docs.limit(0), decoded=True).count() == 0
    import corpus_pipeline
    plan = corpus_pipeline.bpe_stage(spark, docs, "")._jdf.queryExecution().executedPlan().toString()
    # One Python worker in a task: no other step on top of the reassembly.
    assert "MapInArrow" not in plan[:plan.index("FlatMapCoGroupsInArrow")]


def test_full_memory_of_pieces_keeps_those_in_use():
    from wardlens.llm.tokens import PieceEncoder
    asked = []

    def encode(texts):
        asked.extend(w for t in texts for w in t.split())
        return [list(t.encode()) for t in texts]
    encoder = PieceEncoder(encode, {i: bytes([i]) for i in range(128)}, keep=6)
    for words in ("ab cd ef gh ij", "cd ef gh kl mn", "ab mn kl cd"):
        pieces = [f" {w}".encode() for w in words.split()]
        flat, ptr = encoder.ids(pieces)
        assert [bytes(flat[a:b].tolist()) for a, b in zip(ptr, ptr[1:])] == pieces
    assert asked == ["ab", "cd", "ef", "gh", "ij", "kl", "mn", "ab"]


def test_bpe_blocks_take_little_memory(monkeypatch):
    """Two blocks of 4 MB, cut one after another: neither all words as objects
    at once nor what the block before took."""
    import tracemalloc

    import pyarrow as pa
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 4 << 20)
    rng = random.Random(5)
    words = [" " + "".join(rng.choices("etaoinshrdlu", k=6)) for _ in range(300_000)]
    texts = ["".join(rng.choices(words, k=600)) for _ in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(2000)), pa.array(texts)], ["doc_id", "text"])
    size = sum(map(len, texts))
    assert len(list(bpe._to_blocks(bpe.PATTERN, 4, True)(iter([batch])))) == 3  # the last is a rest
    for documents in (False, True):
        tracemalloc.start()
        for _ in bpe._to_blocks(bpe.PATTERN, 4, documents)(iter([batch])):
            pass
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < size * 4, f"{peak} bytes of memory for {size} bytes of text"


def test_gather_takes_little_memory():
    import tracemalloc

    from wardlens.llm.tokens import gather
    rng = np.random.default_rng(5)
    ptr = np.concatenate(([0], np.cumsum(rng.integers(0, 20, 5000))))
    flat = rng.integers(0, 256, ptr[-1]).astype(np.uint8)
    index = rng.integers(0, 5000, 300_000).astype(np.int32)
    tracemalloc.start()
    values, starts = gather(flat, ptr, index)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    want = [flat[ptr[i]:ptr[i + 1]] for i in index]
    assert values.dtype == np.uint8 and np.array_equal(values, np.concatenate(want))
    assert np.array_equal(starts, np.concatenate(([0], np.cumsum([len(w) for w in want]))))
    assert peak < 6 * len(values), f"{peak} bytes for {len(values)}"
    none, starts = gather(flat, ptr, index[:0])
    assert len(none) == 0 and starts.tolist() == [0]
