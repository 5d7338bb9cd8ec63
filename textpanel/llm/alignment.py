"""Cross-tokenizer alignment: which tokens of two encodings of the same bytes overlap, and where both end together.

A byte-level tokenizer A encodes a space and the text, a piece tokenizer B the text, before which it puts a space of its
own. Each encoding gives an array that names, for every byte, the token that owns it. Where the pair of owners changes, a
new overlap (link) begins; where both owners change at once, both encodings have a boundary, and a group of tokens ends.

Links are counted by pair of ids over the whole corpus, each document's own sums first. A document's links are then
joined with these counts: broadcast while the counted pairs are few, by shuffle beyond.

Edge cases: null and empty texts have no tokens, nor has a text of which either encoding doesn't give back space and text
byte by byte (for instance, one that holds the character that B writes for a space). Special tokens' strings are plain
text. Ties for the highest count of a B id all count as best. Repeated rows are aligned and counted each; null ids come
back as null; very long texts are aligned whole; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpanel.llm.common import beside, in_batches, small_batches, stored, table
from textpanel.llm.tokens import GLUED, LETTERS, UNSAFE

SPACE = "▁"
#: Characters of a run of words that a piece tokenizer gets at least.
RUN = 60
#: Words that a worker remembers, and texts whose new words are aligned together.
KNOWN, TEXTS = 200_000, 64
#: Links of documents that a worker gathers before it hands them on.
LINKS = 200_000


class Spellings:
    """Bytes of many tokens one behind the other, so that those of a whole sequence are gathered at once."""

    def __init__(self, parts: list[bytes]):
        self.length = np.array([len(x) for x in parts], np.int32)
        self.start = (np.cumsum(self.length) - self.length).astype(np.int32)
        self.blob = np.frombuffer(b"".join(parts), np.uint8)

    def owners(self, ids: np.ndarray) -> np.ndarray:
        """For every byte of the sequence, which of its tokens it belongs to."""
        return np.repeat(np.arange(len(ids), dtype=np.int32), self.length[ids])

    def spell(self, ids: np.ndarray, owner: np.ndarray) -> np.ndarray:
        length = self.length[ids]
        shift = self.start[ids] - (np.cumsum(length) - length).astype(np.int32)
        return self.blob[shift[owner] + np.arange(len(owner), dtype=np.int32)]


class ByteTokens:
    """A byte-level vocabulary of the `tokenizers` library, as ranks for `tiktoken`, which gives the same ids and takes special strings as plain text."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
        letter = {c: b for b, c in LETTERS.items()}
        raw = {i: bytes(letter[c] for c in token) for token, i in tokenizer.get_vocab().items() if token not in special}
        self.encode = tiktoken.Encoding("ranks", pat_str=GLUED, mergeable_ranks={x: i for i, x in raw.items()}, special_tokens={}).encode_ordinary
        self.raw = [raw.get(i, b"") for i in range(tokenizer.get_vocab_size())]

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.encode(text), np.int32)


class Pieces:
    """A piece tokenizer, fed with short runs of words, which it encodes faster than a long text.

    No piece of its vocabulary goes on behind the blank before a word, so that a text may be cut at single blanks: the
    tokenizer puts the blank back. A text with the character that stands for a blank is encoded whole.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.apart = not any(SPACE in x.lstrip(SPACE) for x in names)
        self.raw = [bytes([int(x[1:-1], 16)]) if self.model.is_byte(i) else x.replace(SPACE, " ").encode() for i, x in enumerate(names)]

    def ids(self, text: str) -> np.ndarray:
        runs, begin = [], 0
        if self.apart and SPACE not in text:
            at = text.find(" ", RUN)
            while 0 <= at < len(text) - 1:
                if text[at - 1] != " " and text[at + 1] != " ":
                    runs.append(text[begin:at])
                    begin = at + 1
                    at = text.find(" ", begin + RUN)
                else:
                    at = text.find(" ", at + 1)
        runs.append(text[begin:])
        return np.fromiter(chain.from_iterable(self.model.encode(runs, num_threads=1)), np.int32)


#: Of a text or of one word with the blank before it: tokens of A, tokens of B, groups, id pairs of all links (A << 32 | B, 64 bits each), the groups written out with `;` after each.
Aligned = tuple[int, int, int, bytes, bytes]
NOTHING: Aligned = (0, 0, 0, b"", b"")


class Aligner:
    """Both tokenizers, the bytes of their tokens, the digits from which groups are written, and a bounded memory of words.

    Neither vocabulary builds a token across a single blank before a word, so that a text's alignment is its words' ones in
    a row. Words that aren't known are put together and aligned at once. Texts with a blank next to other white space, or
    with the character that stands for a blank, are aligned whole.
    """

    def __init__(self, a_path: str, b_path: str, known: int = KNOWN):
        self.a, self.b = ByteTokens(a_path), Pieces(b_path)
        self.a_bytes, self.b_bytes = Spellings(self.a.raw), Spellings(self.b.raw)
        self.written = Spellings([f"{i}{end}".encode() for i in range(len(self.a.raw)) for end in ",|"] + [f"{i}{end}".encode() for i in range(len(self.b.raw)) for end in ",;"])
        self.most, self.known = known, {}

    def words(self, words: list[str]) -> list[Aligned | None]:
        """The alignment of each word with a blank before it; None for one whose bytes an encoding doesn't give back."""
        body = " ".join(words)
        raw = np.frombuffer(f" {body}".encode(), np.uint8)
        a, b = self.a.ids(f" {body}"), self.b.ids(body)
        a_own, b_own = self.a_bytes.owners(a), self.b_bytes.owners(b)
        if not (np.array_equal(self.a_bytes.spell(a, a_own), raw) and np.array_equal(self.b_bytes.spell(b, b_own), raw)):
            return [None] if len(words) == 1 else [self.words([w])[0] for w in words]
        a_new, b_new = a_own[1:] != a_own[:-1], b_own[1:] != b_own[:-1]
        begin = np.concatenate([[0], np.flatnonzero(a_new | b_new) + 1])
        links = (a[a_own[begin]].astype(np.int64) << 32 | b[b_own[begin]]).tobytes()
        # The group of each link, and by the links that open a token the groups of tokens.
        group = np.concatenate([[0], np.cumsum((a_new & b_new)[begin[1:] - 1])])
        n_groups = int(group[-1]) + 1
        a_group, b_group = (group[np.concatenate([[True], new[begin[1:] - 1]])] for new in (a_new, b_new))
        # Of a group, A's tokens come first and then B's: each one's place is its own rank and the other side's tokens before it.
        a_upto, b_upto = (np.concatenate([[0], np.cumsum(np.bincount(g, minlength=n_groups))]) for g in (a_group, b_group))
        a_rank, b_rank = np.arange(len(a)), np.arange(len(b))
        code = np.empty(len(a) + len(b), np.int64)
        code[a_rank + b_upto[a_group]] = 2 * a + (a_rank + 1 == a_upto[a_group + 1])
        code[b_rank + a_upto[b_group + 1]] = 2 * (len(self.a.raw) + b) + (b_rank + 1 == b_upto[b_group + 1])
        text = self.written.spell(code, self.written.owners(code)).tobytes()
        if len(words) == 1:
            return [(len(a), len(b), n_groups, links, text)]
        # Where each word begins: in bytes, and from there in tokens, links, groups and digits.
        at = np.cumsum([0, *[len(w.encode()) + 1 for w in words[:-1]]])
        link = np.searchsorted(begin, at)
        upto = np.concatenate([[0], np.cumsum(self.written.length[code])])
        bounds = [np.append(x, end).tolist() for x, end in ((a_own[at], len(a)), (b_own[at], len(b)), (group[link], n_groups), (8 * link, len(links)), (upto[a_own[at] + b_own[at]], len(text)))]
        of = [zip(x, x[1:]) for x in bounds]  # noqa: B905
        return [(a1 - a0, b1 - b0, g1 - g0, links[l0:l1], text[t0:t1]) for (a0, a1), (b0, b1), (g0, g1), (l0, l1), (t0, t1) in zip(*of, strict=True)]

    def align(self, texts: list[str | None]) -> list[Aligned]:
        """The alignment of each text: nothing where it has no tokens."""
        split: list[list[str] | None] = []
        for text in texts:
            words = text.split(" ") if text else []
            split.append(None if not self.b.apart or "" in words or text and (UNSAFE.search(text) or SPACE in text) else words)
        new = list({w for words in split if words for w in words if w not in self.known})
        made = dict(zip(new, self.words(new), strict=True)) if new else {}
        out = []
        for text, words in zip(texts, split, strict=True):
            if words is None:
                parts = self.words([text])
            else:
                parts = [self.known.get(w) or made.get(w) for w in words]
            if not parts or None in parts:
                out.append(NOTHING)
            else:
                n_a, n_b, n_groups, links, written = zip(*parts, strict=True)
                out.append((sum(n_a), sum(n_b), sum(n_groups), b"".join(links), b"".join(written)))
        if len(self.known) < self.most:
            self.known |= {w: x for w, x in made.items() if x}
        return out


@lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def align(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text", written: bool = True) -> DataFrame:
    """Per row: doc_id, row (a number of its own), n_a, n_b, n_groups, n_links, groups_sha256, pairs (A << 32 | B) and times of its distinct links; `groups` written out if `written`."""
    small_batches(docs.sparkSession)
    src = docs.select(F.col(key).alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times", *["groups"] * written]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(a_path, b_path)
        for batch in batches:
            texts, begin, held = batch.column(2), 0, 0
            rows: list[tuple] = []

            def made(begin=begin, rows=rows, batch=batch) -> pa.RecordBatch:
                ends = np.concatenate([[0], np.cumsum([len(r[5]) for r in rows])]).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([r[i] for r in rows]).astype(t))) for i, t in ((5, np.int64), (6, np.int32))]
                columns = [*[batch.column(i).slice(begin, len(rows)) for i in (0, 1)], *[pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], pa.array([r[4] for r in rows], pa.string()), *lists]
                return pa.RecordBatch.from_arrays(columns + [pa.array([r[7] for r in rows], pa.string())] * written, names=names)

            found = (x for part in in_batches(iter(texts.to_pylist()), TEXTS) for x in both.align(part))
            for k, (n_a, n_b, n_groups, linked, groups) in enumerate(found):
                links, groups = np.frombuffer(linked, np.int64), groups[:-1]
                pairs, times = np.unique(links, return_counts=True)
                rows.append((n_a, n_b, n_groups, len(links), hashlib.sha256(groups).hexdigest() if groups else "", pairs, times, groups.decode() if written else None))
                held += len(pairs)
                if held > LINKS:
                    yield made(begin, rows)
                    rows, begin, held = [], k + 1, 0
            if rows:
                yield made(begin, rows)

    return src.mapInArrow(run, f"doc_id {kind}, row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>" + ", groups string" * written)


def link_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): how many links of the corpus hold an id pair linked, and whether no pair of its B id has more."""
    n = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("n"))
    n = stored(n, "link-counts").withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    most = n.groupBy("b").agg(F.max("n").alias("most"))
    return n.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def with_counts(aligned: DataFrame) -> DataFrame:
    """`aligned`, a stored table, with n_best and count_sum of each row in place of its links."""
    counts = beside(stored(link_counts(aligned), "best-links"), 16)
    links = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    sums = links.join(counts, "pair").groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    none = F.lit(0).cast("long")
    return aligned.drop("pairs", "times").join(sums, "row", "left").withColumns({"n_best": F.coalesce("n_best", none), "count_sum": F.coalesce("count_sum", none)}).drop("row")


def op13_query(spark, sf_dir):
    import public_tokenizers

    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return with_counts(stored(align(table(spark, sf_dir, "documents"), a, b, written=False), "aligned"))
