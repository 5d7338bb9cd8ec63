import collections
import hashlib

import duckdb
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from textpanel.llm import alignment

SF = "/root/testdata/sf0.001"
A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = [None, "", " ", "a", "  two  blanks ", "x▁y", "▁", "<|endoftext|> <s> </s> <unk> <0x41>", "é́ ﬁ ｆｕｌｌ", "🙂🙂 中文", "a\r\n\tb\n\n c", " x　y", "\x00\x01", "word " * 3000, "I'm, 'll. 123 4567 ---", "naïve façade Straße"]


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def brute(tokenizers, texts):
    """Rows and links by spans of bytes, with no arrays of owners."""
    a, b = tokenizers
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in printable} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in printable)}
    docs = []
    for text in texts:
        raw = f" {text}".encode() if text else b""
        ids_a, ids_b = (a.encode(f" {text}", add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not (b"".join(bytes_a) == b"".join(bytes_b) == raw):
            ids_a, ids_b, bytes_a, bytes_b = [], [], [], []
        ends = []
        for parts in (bytes_a, bytes_b):
            at, out = 0, []
            for x in parts:
                out.append((at, at + len(x)))
                at += len(x)
            ends.append(out)
        links, groups, i, j = [], [], 0, 0
        for k, (s, e) in enumerate(ends[0]):
            while j < len(ends[1]) and ends[1][j][1] <= s:
                j += 1
            m = j
            while m < len(ends[1]) and ends[1][m][0] < e:
                links.append((ids_a[k], ids_b[m]))
                m += 1
        cuts = sorted({e for _, e in ends[0]} & {e for _, e in ends[1]})
        at = 0
        for c in cuts:
            groups.append(",".join(str(x) for x, (s, _) in zip(ids_a, ends[0], strict=True) if at <= s < c) + "|" + ",".join(str(x) for x, (s, _) in zip(ids_b, ends[1], strict=True) if at <= s < c)) if len(cuts) < 400 else groups.append(None)
            at = c
        docs.append((len(ids_a), len(ids_b), len(cuts), links, groups))
    n = collections.Counter(x for d in docs for x in d[3])
    most = collections.defaultdict(int)
    for (_, y), k in n.items():
        most[y] = max(most[y], k)
    rows = []
    for n_a, n_b, n_groups, links, groups in docs:
        sha = None if None in groups else hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        rows.append((n_a, n_b, n_groups, len(links), sum(n[x] == most[x[1]] for x in links), sum(n[x] for x in links), sha))
    return rows


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def agree(got, want):
    return len(got) == len(want) and all(g[:6] == w[:6] and w[6] in (None, g[6]) for g, w in zip(got, want, strict=True))


def test_query_equals_brute_force(spark, tokenizers):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
    df = alignment.op13_query(spark, SF)
    assert set(df.columns) == {"doc_id", *COLUMNS}
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in df.collect()}
    assert agree([got[k] for k, _ in docs], brute(tokenizers, [t for _, t in docs]))


def test_odd_null_and_repeated_rows(spark, tokenizers, monkeypatch):
    monkeypatch.setattr(alignment, "LINKS", 3)
    rows = [(None if i % 5 == 0 else i % 7, i, t, "x") for i, t in enumerate([*ODD, *ODD])]
    df = spark.createDataFrame(rows, "doc_id long, nr long, text string, row string")
    got = alignment.with_counts(alignment.stored(alignment.align(df, A, B, key="nr"), "odd-rows")).orderBy("doc_id").collect()
    want = brute(tokenizers, [r[2] for r in rows])
    assert agree([tuple(r[c] for c in COLUMNS) for r in got], want) and want[5][:6] == (0,) * 6 and want[3][0] > 0
    assert all(hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256 for r in got if r.n_a)
    ids = alignment.with_counts(alignment.stored(alignment.align(df, A, B, written=False), "odd-ids")).collect()
    assert collections.Counter(r.doc_id for r in ids) == collections.Counter(r[0] for r in rows)
    assert alignment.with_counts(alignment.stored(alignment.align(df.limit(0), A, B), "no-rows")).collect() == []


def test_counts_join_by_shuffle_too(spark, monkeypatch):
    rows = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    whole = alignment.stored(alignment.align(rows, A, B, written=False), "both-ways")
    one = sorted(map(tuple, alignment.with_counts(whole).collect()))
    monkeypatch.setattr("textpanel.llm.common.BROADCAST", 0)
    assert sorted(map(tuple, alignment.with_counts(whole).collect())) == one


def test_cuts_and_ranks_change_no_id(tokenizers, monkeypatch):
    texts = [t for (t,) in duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet'").fetchall()] + ODD
    a, b = alignment.ByteTokens(A), alignment.Pieces(B)
    assert b.apart
    for run in (0, 1, 60):
        monkeypatch.setattr(alignment, "RUN", run)
        for t in texts:
            if t:
                assert b.ids(t).tolist() == tokenizers[1].encode(t)
    for t in texts:
        if t:
            assert a.ids(f" {t}").tolist() == tokenizers[0].encode(f" {t}", add_special_tokens=False).ids


def test_words_in_a_row_are_the_whole(tokenizers):
    texts = [t for (t,) in duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet'").fetchall()] + ODD
    some = alignment.Aligner(A, B, known=300)
    for text, got in zip(texts, some.align(texts) + some.align(texts), strict=False):
        whole = some.words([text])[0] if text else None
        assert got == (whole or alignment.NOTHING)
    assert 300 <= len(some.known) < 100_000
