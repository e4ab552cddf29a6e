"""Token counts without token ids.

A tokenizer that drops white space never joins characters across it, so a text has as many tokens as its
white-space separated pre-tokens have in sum. Each distinct pre-token of the corpus is given to the tokenizer once:

1. every task counts its pre-tokens, one shuffle sums them (`piece, n`);
2. the distinct pre-tokens are encoded in parallel and stored with their piece counts;
3. the `head` most frequent ones (a fixed number of short strings) go to the tasks as a lookup table, the rest is
   joined to the per-document frequencies by a shuffle. Which side a pre-token is on changes the plan, not the sum.

Defined results: null and empty texts have 0 bytes and 0 tokens; repeated rows and repeated ids keep a row each;
null ids stay; added columns are never touched, since only the id and the text are read; an empty table gives none.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hourweave.llm.common import col, ship_package, slices, texts
from hourweave.session import materialise

#: Unicode White_Space. str.split() also splits at U+001C to U+001F, which the tokenizer takes for symbols.
_SPACE = re.compile("[" + "".join(c for c in map(chr, range(0x3001)) if c.isspace() and not "\x1c" <= c <= "\x1f") + "]+")
_NOT_SPACE = re.compile("[\x1c-\x1f]")

HEAD = 1 << 19
HEAD_CHARS = 32


@lru_cache(maxsize=4)
def load_tokenizer(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def pre_tokens(text: str) -> list[str]:
    if _NOT_SPACE.search(text):
        return [p for p in _SPACE.split(text) if p]
    return text.split()


def _count_pieces(flush: int = 500_000) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        seen: Counter[str] = Counter()
        for part in slices(batches):
            for text in texts(part.column(0)):
                seen.update(pre_tokens(text))
            if len(seen) >= flush:
                yield from _counted(seen)
                seen = Counter()
        yield from _counted(seen)

    return run


def _counted(seen: Counter[str], rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    table = pa.table({"piece": pa.array(seen.keys(), pa.string()), "n": pa.array(seen.values(), pa.int64())})
    yield from table.to_batches(max_chunksize=rows)


def vocabulary(docs: DataFrame, text: str, tokenizer: str) -> DataFrame:
    """Every distinct pre-token of the corpus: `piece`, its frequency `n`, its number of tokens `pieces`; stored."""

    def encode(batches):
        library = load_tokenizer(tokenizer)
        for part in slices(batches, 4096):
            found = library.encode_batch_fast(part.column(0).to_pylist(), add_special_tokens=False)
            yield pa.record_batch({"piece": part.column(0), "n": part.column(1), "pieces": pa.array([len(x) for x in found], pa.int64())})

    counted = docs.select(col(text).cast("string")).mapInArrow(_count_pieces(), "piece string, n long")
    summed = counted.groupBy("piece").agg(F.sum("n").alias("n"))
    return materialise(summed.mapInArrow(encode, "piece string, n long, pieces long"), "vocabulary")


def _most_frequent(pieces: DataFrame, most: int) -> DataFrame:
    """At most `most` pieces: those at or above the smallest frequency that so many reach."""
    at_least = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, 0)
    # one row for each frequency that occurs
    reached = pieces.groupBy("n").agg(F.count("*").alias("with_n")).select("n", F.sum("with_n").over(at_least).alias("so_many"))
    least = reached.where(F.col("so_many") <= most).agg(F.min("n")).first()[0]
    return pieces.where(F.lit(False) if least is None else F.col("n") >= least)


def count_tokens(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text: str = "text", head: int = HEAD) -> DataFrame:
    """One row per document: its id, `n_bytes` (UTF-8) and `n_tokens` without added special tokens."""
    spark = docs.sparkSession
    ship_package(spark)
    pieces = vocabulary(docs, text, tokenizer)
    top = _most_frequent(pieces.where(F.length("piece") <= HEAD_CHARS), head).select("piece", "pieces").toArrow()
    known = spark.sparkContext.broadcast(dict(zip(top["piece"].to_pylist(), top["pieces"].to_pylist())))
    kind = docs.schema[id_column].dataType

    def look_up(batches):
        get = known.value.get
        for part in slices(batches):
            sizes, sums, rest = [], [], []
            for value in texts(part.column(1)):
                words = pre_tokens(value)
                counts = list(map(get, words))
                missing = Counter(w for w, c in zip(words, counts) if c is None) if None in counts else {}
                sizes.append(len(value.encode()))
                sums.append(sum(c for c in counts if c) if missing else sum(counts))
                rest.append(list(missing.items()))
            yield pa.record_batch({
                id_column: part.column(0), "n_bytes": pa.array(sizes, pa.int64()), "head_tokens": pa.array(sums, pa.int64()),
                "rest": pa.array([[{"piece": p, "f": f} for p, f in r] for r in rest], pa.list_(pa.struct([("piece", pa.string()), ("f", pa.int64())]))),
            })

    slim = docs.select(col(id_column), col(text).cast("string"))
    schema = f"`{id_column}` {kind.simpleString()}, n_bytes long, head_tokens long, rest array<struct<piece: string, f: bigint>>"
    # a file's row positions are fixed once it is stored, so a repeated task cannot change them
    per_doc = materialise(slim.mapInArrow(look_up, schema), "piece-frequencies").select(
        "*", F.struct(F.col("_metadata.file_name"), F.col("_metadata.row_index")).alias("row"))
    rest = per_doc.select("row", F.inline("rest")).join(pieces.select("piece", "pieces"), "piece")
    sums = rest.groupBy("row").agg(F.sum(F.col("f") * F.col("pieces")).alias("rest_tokens"))
    return per_doc.drop("rest").join(sums, "row", "left").select(
        col(id_column), "n_bytes", (F.col("head_tokens") + F.coalesce("rest_tokens", F.lit(0))).alias("n_tokens"))
