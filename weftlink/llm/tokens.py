"""Token counts: pieces counted once per distinct pre-token, joined to per-document
pre-token frequencies and summed; no ids of a document are ever materialised.

A table of common pre-tokens (the head) comes from a bounded sample of documents and goes to
every task. One pass over the documents splits each text and sums up what the head knows;
the pre-tokens that it does not know (the tail) leave as (document, pre-token, frequency).
Each distinct one of these is counted once in the whole job and joined back. Which of them
are in the head changes the work, never a count."""

from __future__ import annotations

import json
import os
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .common import open_store, staged, written

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024
#: Documents that the head is taken from (about), bytes that it holds at most, and the
#: longest pre-token in it, in bytes.
SAMPLE_ROWS = 16384
HEAD_BYTES = 16 << 20
HEAD_LONGEST = 64
#: Characters of text that a task counts before it hands on the tail.
BLOCK = 4_000_000
#: Fixed value: the split of byte-level tokenizers; and what texts hold no letter, digit or
#: space whose class a Unicode version moved.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN = r"[^\x00-ɏЀ-ҁ‐-‧‰-⁞₠-₹]"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Splitter:
    """Pre-tokens of texts, and pieces of pre-tokens, as a tokenizer's file has them.

    ``kind`` says how, by what the file states. "pattern": byte-level splitting by the
    pattern above, without a normalizer. "library": by the library's own normalizer and
    pre-tokenizer. "whole": a text is one pre-token (sentencepiece models, files without
    a pre-tokenizer or with added tokens that look beyond their own string)."""

    def __init__(self, path: str):
        self.marks = None
        if path.endswith(".model"):
            import sentencepiece

            self.kind, self.model = "whole", sentencepiece.SentencePieceProcessor(model_file=path)
            return
        import regex
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        split, added = file.get("pre_tokenizer"), file.get("added_tokens") or []
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        odd = any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] and file.get("normalizer") for t in added)
        if split is None or odd:
            self.kind = "whole"
        elif file.get("normalizer") is None and {k: split.get(k, True) for k in plain} == plain:
            self.kind = "pattern"
        else:
            self.kind = "library"
        if self.kind != "whole" and added:
            # added tokens inside a text are taken first, each as one token
            self.marks = regex.compile("|".join(regex.escape(t["content"]) for t in sorted(added, key=lambda t: -len(t["content"]))))
        self.find, self.odd = regex.compile(PATTERN).findall, regex.compile(PLAIN).search

    def _part(self, text: str) -> list[str]:
        if self.kind == "pattern":
            if not self.odd(text):
                return self.find(text)
            return [text[a:b] for _, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(text)]
        if self.tok.normalizer is not None:
            text = self.tok.normalizer.normalize_str(text)
        return [p for p, _ in self.tok.pre_tokenizer.pre_tokenize_str(text)]

    def split(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text, and how many added tokens it holds."""
        if self.kind == "whole":
            return ([text] if text else []), 0
        if self.marks is None or not self.marks.search(text):
            return self._part(text), 0
        parts = self.marks.split(text)
        return [p for x in parts for p in self._part(x)], len(parts) - 1

    def pieces(self, pretokens: list[str]) -> list[int]:
        if self.kind == "whole" and not hasattr(self, "tok"):
            return [len(x) for x in self.model.encode(pretokens, num_threads=1)]
        if self.kind == "library":
            return [len(self.tok.model.tokenize(p)) for p in pretokens]
        out: list[int] = []
        for i in range(0, len(pretokens), 20_000):
            out += map(len, self.tok.encode_batch_fast(pretokens[i : i + 20_000], add_special_tokens=False))
        return out


def _splitter(path: str, known: dict = {}) -> Splitter:  # noqa: B006
    """One for a worker process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in known:
        known[path] = Splitter(path)
    return known[path]


def _head(folder: str, known: dict = {}) -> dict[str, int]:  # noqa: B006
    """The head's table, read from the shared folder once by a worker process."""
    if folder not in known:
        from pyarrow import dataset

        known.clear()
        store, path = open_store(folder)
        t = dataset.dataset(path, filesystem=store, format="parquet").to_table()
        known[folder] = dict(zip(t["t"].to_pylist(), t["pieces"].to_pylist(), strict=True))
    return known[folder]


def _frequencies(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        s, all_ = _splitter(path), Counter()
        for pdf in batches:
            for t in pdf["text"]:
                all_.update(s.split(t)[0])
            if len(all_) > 500_000:
                yield pd.DataFrame({"t": list(all_), "n": list(all_.values())})
                all_ = Counter()
        yield pd.DataFrame({"t": list(all_), "n": list(all_.values())})

    return run


def _pieces(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        s = _splitter(path)
        for pdf in batches:
            yield pd.DataFrame({"t": pdf["t"], "pieces": s.pieces(pdf["t"].tolist())})

    return run


def head(docs: DataFrame, text_col: str, path: str) -> str:
    """The folder of (t, pieces) of the commonest pre-tokens of a sample of the documents, as
    many as ``HEAD_BYTES`` hold."""
    n = docs.count()
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    some = texts.sample(False, min(1.0, SAMPLE_ROWS / max(1, n)), 7)
    freq = some.mapInPandas(_frequencies(path), "t string, n long").groupBy("t").agg(F.sum("n").alias("n"))
    freq = staged(freq.where(F.octet_length("t") <= HEAD_LONGEST), "token-sample")
    # bytes by frequency: few distinct frequencies, so few rows
    steps = freq.groupBy("n").agg(F.sum(F.octet_length("t") + 16).alias("b")).orderBy(F.desc("n")).collect()
    least, held = None, 0
    for r in steps:
        held += r["b"]
        if held > HEAD_BYTES:
            break
        least = r["n"]
    common = freq.where(F.lit(False) if least is None else F.col("n") >= least)
    return written(common.select("t").mapInPandas(_pieces(path), "t string, pieces long"), "token-head")


def _counts(path: str, folder: str):
    """Arrow batches (id, n_bytes, text) -> (key, id, n_bytes, tokens, tail): tokens counts
    what the head knows, tail holds the rest with its frequencies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        s, known = _splitter(path), _head(folder).get
        key = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts, at = batch.column(2), 0
            while at < len(texts):
                tokens, ends, words, counts, size, first = [], [0], [], [], 0, at
                while at < len(texts) and size <= BLOCK:
                    text = texts[at].as_py()
                    size, at = size + len(text), at + 1
                    pre, total = s.split(text)
                    for t, n in Counter(pre).items():
                        p = known(t)
                        if p is None:
                            words.append(t)
                            counts.append(n)
                        else:
                            total += n * p
                    tokens.append(total)
                    ends.append(len(words))
                tail = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64())], ["t", "n"]))
                part = batch.slice(first, at - first)
                keys = pa.array(range(key, key + at - first), pa.int64())
                key += at - first
                yield pa.RecordBatch.from_arrays([keys, part.column(0), part.column(1), pa.array(tokens, pa.int64()), tail], ["key", "id", "n_bytes", "tokens", "tail"])

    return run


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row: as many tokens as the library's own
    encoding of the whole text gives, without added special tokens.

    Null texts count as empty; special strings inside texts are tokens, as the library has
    it; repeated rows and null ids are rows like any; an empty table gives none; other
    columns are ignored."""
    path = path or tokenizer_path()
    folder = head(docs, text_col, path)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    tail = ArrayType(StructType([StructField("t", StringType()), StructField("n", LongType())]))
    schema = StructType([StructField("key", LongType()), *rows.schema.fields[:2], StructField("tokens", LongType()), StructField("tail", tail)])
    done = staged(rows.mapInArrow(_counts(path, folder), schema), "token-rows")
    tail = done.select("key", F.inline("tail"))
    each = tail.select("t").distinct().mapInPandas(_pieces(path), "t string, pieces long").select(F.col("t").alias("u"), "pieces")
    late = tail.join(each, F.col("t") == F.col("u")).select("key", F.lit(None).cast(rows.schema["id"].dataType).alias("id"), F.lit(None).cast("long").alias("n_bytes"), (F.col("n") * F.col("pieces")).alias("tokens"))
    total = done.drop("tail").unionByName(late).groupBy("key").agg(F.max("id").alias(id_col), F.max("n_bytes").alias("n_bytes"), F.sum("tokens").alias("n_tokens"))
    return total.select(id_col, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
