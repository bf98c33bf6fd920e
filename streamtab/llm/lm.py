"""Language-model scoring of whole documents.

Words are counted over all training documents. The commonest are words of the recurrent model of `rnn`; rarer ones fall into buckets
that the model predicts, and within a bucket a word has its share of the corpus. Counts of words outside a broadcast table of bounded
size are joined. The network learns in rounds: each partition of a round's documents updates a copy from the same
start, and copies are averaged by the tokens they saw.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamtab.llm import rnn
from streamtab.llm.common import batches, saved, word_lists

# Words whose counts are broadcast, words of the network, buckets of the others.
TABLE_WORDS, NETWORK_WORDS, BUCKETS = 1 << 18, 48 * rnn.CLASS_SIZE, 32
ROUNDS = 2
# Words that are counted at once.
COUNTED_BYTES = 1 << 26
CHUNK_TOKENS = 1 << 22
END = b""


def bucket_of(word: bytes) -> int:
    return word[-1] % BUCKETS if word else 0


def count_words(spark: SparkSession, texts: DataFrame) -> DataFrame:
    """(word, n) over `texts`, the end of each text as the empty word. Tasks count before they shuffle, in bounded memory."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ends, size = [], 0, 0

        def flush() -> pa.RecordBatch:
            found = pa.chunked_array(held, pa.string()).value_counts()
            listed = pa.concat_arrays([found.field("values").cast(pa.binary()), pa.array([END], pa.binary())])
            return pa.RecordBatch.from_pydict({"word": listed, "n": pa.concat_arrays([found.field("counts"), pa.array([ends], pa.int64())])})

        for batch in batches(parts, chars=1 << 22):
            held.append(word_lists(batch["text"])[0])
            ends, size = ends + batch.num_rows, size + held[-1].nbytes
            if size > COUNTED_BYTES:
                yield flush()
                held, ends, size = [], 0, 0
        yield flush()

    counted = texts.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return saved(spark, counted.where("n > 0"), "lm-counts")


class Table:
    """The commonest words with their counts, and what the network and the buckets know of the corpus."""

    def __init__(self, counts: DataFrame):
        total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
        self.tokens, self.types = int(total[0]), int(total[1])
        # Counts in steps of a sixteenth of a doubling: the table takes every step that it has room for.
        step = F.floor(F.log2("n") * 16).cast("int")
        steps = sorted((r["step"], r["types"]) for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("types")).collect())
        room, least = TABLE_WORDS, math.inf
        for at, types in reversed(steps):
            if types > room:
                break
            room, least = room - types, at
        self.in_table = step >= F.lit(least) if least < math.inf else F.lit(False)
        listed = counts.where(self.in_table).toPandas()
        order = sorted(zip(listed["n"].tolist(), map(bytes, listed["word"])), key=lambda r: (-r[0], r[1]))
        self.words = [w for _, w in order]
        self.counts = np.array([n for n, _ in order], np.int64)
        self.buckets = np.array([bucket_of(w) for w in self.words], np.int64)
        own = min(NETWORK_WORDS, len(order))
        # Tokens and types of each bucket: everything outside the network's words.
        last = F.pmod(F.conv(F.hex(F.substring("word", -1, 1)), 16, 10).cast("int"), F.lit(BUCKETS))
        sums = counts.groupBy(F.coalesce(last, F.lit(0)).alias("bucket")).agg(F.sum("n").alias("n"), F.count("*").alias("types")).collect()
        self.sizes = np.zeros(BUCKETS)
        mass = np.zeros(BUCKETS)
        for r in sums:
            mass[r["bucket"]], self.sizes[r["bucket"]] = r["n"], r["types"]
        np.subtract.at(mass, self.buckets[:own], self.counts[:own])
        np.subtract.at(self.sizes, self.buckets[:own], 1)
        self.sizes += mass + 1
        filled = np.zeros(NETWORK_WORDS)
        filled[:own] = self.counts[:own]
        by_class = filled.reshape(-1, rnn.CLASS_SIZE) + 0.01
        self.log_word = np.log(by_class / by_class.sum(axis=1, keepdims=True))
        share = np.concatenate([by_class.sum(axis=1), mass + 1])
        self.log_class = np.log(share / share.sum())
        self.end = self.words.index(END) if END in self.words[:own] else NETWORK_WORDS + bucket_of(END)

    def lookup(self) -> dict[bytes, int]:
        return {w: i for i, w in enumerate(self.words)}


ENCODED = (
    "doc_id {kind}, held_out boolean, n_tokens long, known long, base double, rare double, ids binary, rare_words array<binary>, rare_times array<int>"
)


def encode(spark: SparkSession, rows: DataFrame, table: Table) -> DataFrame:
    """Each document as network ids, with its sums over words of the table and the words outside it.

    `base` sums log10(c + 1) over words of the table; `rare` sums, over words outside the network, log10 of their share of the
    bucket, less log10(c + 1) for words outside the table, which is joined later.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast((table.words, table.counts, table.buckets, table.sizes))

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, counts, buckets, sizes = shared.value
        known = pa.array(listed, pa.binary()).cast(pa.string())
        end = listed.index(END) if END in listed else -1
        log_count, log_size = np.log10(counts + 1.0), np.log10(sizes)
        network = np.where(np.arange(len(listed)) < NETWORK_WORDS, np.arange(len(listed)), NETWORK_WORDS + buckets).astype(np.uint16)
        for batch in batches(parts, rows=4000, chars=1 << 23):
            found, reach = word_lists(batch["text"])
            # Places in the table (-1: outside) of all words of the batch, the end of each text after its words.
            at = np.insert(pc.index_in(found, value_set=known).fill_null(-1).to_numpy(), reach[1:], end)
            cuts = reach + np.arange(len(reach))
            inside, is_end = at >= 0, np.zeros(len(at), bool)
            is_end[cuts[1:] - 1] = True
            rest = iter(found.filter(pa.array(~inside[~is_end])).cast(pa.binary()).to_pylist())
            others = [END if e else next(rest) for e in is_end[~inside].tolist()]
            ids = np.empty(len(at), np.uint16)
            ids[inside] = network[at[inside]]
            ids[~inside] = [NETWORK_WORDS + bucket_of(w) for w in others]
            base, rare = np.zeros(len(at)), np.zeros(len(at))
            base[inside] = log_count[at[inside]]
            away = ids >= NETWORK_WORDS
            rare[away] = base[away] - log_size[ids[away].astype(np.int64) - NETWORK_WORDS]
            reach = np.append(0, np.cumsum(~inside))[cuts].tolist()
            times = [Counter(others[x:y]) for x, y in zip(reach[:-1], reach[1:])]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch["doc_id"], "held_out": batch["held_out"], "n_tokens": pa.array(np.diff(cuts)),
                 "known": pa.array(np.add.reduceat(inside.astype(np.int64), cuts[:-1])), "base": pa.array(np.add.reduceat(base, cuts[:-1])),
                 "rare": pa.array(np.add.reduceat(rare, cuts[:-1])),
                 "ids": pa.Array.from_buffers(pa.binary(), len(times), [None, pa.py_buffer((2 * cuts).astype(np.int32)), pa.py_buffer(ids)]),
                 "rare_words": pa.array([list(t) for t in times], pa.list_(pa.binary())),
                 "rare_times": pa.array([list(t.values()) for t in times], pa.list_(pa.int32()))})

    coded = rows.mapInArrow(read, ENCODED.format(kind=kind))
    return saved(spark, coded.withColumn("row", F.monotonically_increasing_id()), "lm-encoded")


def train(spark: SparkSession, coded: DataFrame, table: Table, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """The network after every training document was read once; documents are dealt to rounds by a hash of their content.

    The parameters, whose number is fixed, are what reaches the driver, as averages made by Spark.
    """
    model = rnn.initial(table.log_word, table.log_class)
    end = table.end
    turn = F.pmod(F.xxhash64(F.lit(7), "ids"), F.lit(rounds))
    for number in range(rounds):
        shared = spark.sparkContext.broadcast(model)

        def learn(parts: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = {k: v.copy() for k, v in shared.value.items()}
            run, seen = rnn.Pass(own, end, learn=True), 0
            rows = ((np.frombuffer(ids, np.uint16).astype(np.int32),) for batch in parts for ids in batch["ids"].to_pylist())
            for chunk in rnn.chunks(rows, CHUNK_TOKENS):
                run.run([r[0] for r in chunk])
                seen += sum(len(r[0]) for r in chunk)
            if seen:
                yield pa.RecordBatch.from_pydict({"seen": pa.array([seen]), "values": pa.array([rnn.flat(own)], pa.list_(pa.float32()))})

        own = coded.where(~F.col("held_out") & (turn == number)).select("ids")
        learnt = own.mapInArrow(learn, "seen long, values array<float>").select("seen", F.posexplode("values").alias("at", "value"))
        mean = learnt.groupBy("at").agg((F.sum(F.col("value").cast("double") * F.col("seen")) / F.sum("seen")).alias("value")).toPandas()
        if len(mean):
            values = np.empty(len(mean))
            values[mean["at"].to_numpy()] = mean["value"].to_numpy()
            model = rnn.shaped(values, model)
    return model


def network_scores(spark: SparkSession, coded: DataFrame, model: dict[str, np.ndarray], end: int) -> DataFrame:
    """(row, network): log10 probability that the network gives each document's ids, from its first word to its end."""
    shared = spark.sparkContext.broadcast(model)

    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = rnn.Pass(shared.value, end)
        rows = ((np.frombuffer(ids, np.uint16).astype(np.int32), row) for b in parts for ids, row in zip(b["ids"].to_pylist(), b["row"].to_pylist()))
        for chunk in rnn.chunks(rows, CHUNK_TOKENS):
            found = run.run([r[0] for r in chunk]) / math.log(10)
            yield pa.RecordBatch.from_pydict({"row": pa.array([r[1] for r in chunk], pa.int64()), "network": pa.array(found)})

    return coded.select("ids", "row").mapInArrow(score, "row long, network double")


def score_documents(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 7, held: int = 2) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of `docs`.

    Rows whose crc32 of the key as text (null: empty) leaves `held` are scored but not learnt from. Null and empty texts are the
    end token alone. Without training rows every word is unknown. Repeated rows count as often as they come.
    """
    fold = F.pmod(F.crc32(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).cast("binary")), F.lit(folds))
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), (fold == held).alias("held_out"))
    counts = count_words(spark, rows.where(~F.col("held_out")).select("text"))
    table = Table(counts)
    coded = encode(spark, rows, table)
    model = train(spark, coded, table)
    scored = network_scores(spark, coded, model, table.end)

    rare = coded.select("row", F.explode(F.arrays_zip("rare_words", "rare_times")).alias("w")).select("row", F.col("w.rare_words").alias("word"), F.col("w.rare_times").alias("times"))
    rare = rare.join(counts.where(~table.in_table), "word").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("rare_logs"), F.sum("times").alias("rare_known")
    )
    facts = coded.select("row", "doc_id", "held_out", "n_tokens", "known", "base", "rare")
    out = facts.join(scored, "row").join(rare, "row", "left")
    logs = F.coalesce("rare_logs", F.lit(0.0))
    whole = F.lit(math.log10(table.tokens + table.types + 1))
    return out.select(
        F.col("doc_id").alias(key),
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(table.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * whole).alias("base_score"),
        (F.col("network") + F.col("rare") + logs).alias("score"),
    )
