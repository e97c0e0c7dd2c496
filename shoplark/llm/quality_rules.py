"""Quality rules by tokeniser fertility.

A public byte-fallback vocabulary is applied to every word; a text is judged by characters per token, the share of
byte-fallback tokens and the entropy of its tokens, against rejection bands of its language, or of its main script
where the language has no band. Base counts (repeated lines and windows of words, symbols) come first.

Bands are fitted on all documents that pass the base rules and have enough tokens: the median of a measure in a
language or script, and so many robust standard deviations (quartile range / 1.349) to both sides. Quartiles are
exact on bins that do not depend on the partitioning. A language or script of too few documents has no fitted band;
scripts then have a fixed, wide one. Tokens are those of the words, each encoded by itself: white space is not judged.

Null and empty texts have no words, so they fail the base rule on length; texts without tokens have no verdict of
their own; a null language goes by script; repeated rows are judged each; an empty table gives no rows; only the id,
text and language columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import asdict, dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Interned, array_slices, as_list, hold_memory, mix64, ragged, stored
from .tokens import PIECE_CHARS, PIECES, cut_words, ends_of

SYMBOLS = "[#*$%&|<>]"
BLANKS = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Band:
    """Outside of it a text is rejected. Entropy (bits) is asked of texts with enough tokens to show it."""

    least_chars: float
    most_chars: float
    most_bytes: float
    least_entropy: float = 3.0


#: Bands of scripts without enough documents to fit one. Wide: they take out what a vocabulary made on web text
#: cannot have been made for (random strings, mis-decoded bytes, one token again and again), not a style.
SCRIPT_BANDS = {
    "latin": Band(1.3, 9.0, 0.15),
    "cyrillic": Band(1.0, 8.0, 0.20),
    "greek": Band(0.7, 6.0, 0.40),
    "cjk": Band(0.3, 4.0, 0.75),
    "other": Band(0.3, 9.0, 0.85),
}
#: Code point ranges by which a script is told (Unicode blocks).
SCRIPTS = (("latin", 0x41, 0x24F), ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F), ("cjk", 0x3040, 0x30FF), ("cjk", 0x3400, 0x9FFF), ("cjk", 0xAC00, 0xD7AF))
SCRIPT_NAMES = ("latin", "greek", "cyrillic", "cjk", "other")
ENTROPY_TOKENS = 64
#: Least robust standard deviation of each measure, and its bins to one.
FLOORS = {"chars": (0.02, 512), "bytes": (0.01, 1024), "bits": (0.1, 64)}
#: Languages whose bands are sent to all tasks; more are joined.
SENT_BANDS = 10_000
FIELDS = ("doc_id long", "n_words long", "word_chars long", "n_symbols long", "n_dup_lines long", "n_repeat_words long", "n_tokens long", "chars_per_token double", "byte_share double", "token_entropy double", "script string", "lang string", "base_failed boolean")


def script_numbers(points: np.ndarray) -> np.ndarray:
    """Of code points, as places in SCRIPT_NAMES; -1 for characters that tell no script."""
    out = np.where(points > 0x24F, SCRIPT_NAMES.index("other"), -1)
    for name, low, high in SCRIPTS:
        out[(points >= low) & (points <= high)] = SCRIPT_NAMES.index(name)
    return out


class Fertility:
    """Token ids of words, and the script letters in them; each distinct word is encoded once per worker."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.get_piece_size())])
        self._reset()

    def _reset(self) -> None:
        self.memo, self.held = Interned(), 0
        self.start, self.length, self.chars, self.bytes = (np.zeros(0, np.int64) for _ in range(4))
        self.letters, self.flat = np.zeros((0, len(SCRIPT_NAMES)), np.int32), np.zeros(0, np.int32)

    def number(self, words: list[str]) -> np.ndarray:
        if len(self.memo) > PIECES or self.held > PIECE_CHARS:
            self._reset()
        at = np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words))
        if pending := self.memo.pending:
            ids = self.model.encode(pending, num_threads=1)
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter(chain.from_iterable(ids), np.int32, int(lengths.sum()))
            chars = np.fromiter(map(len, pending), np.int64, len(pending))
            scripts = script_numbers(np.frombuffer("".join(pending).encode("utf-32-le", "surrogatepass"), np.uint32))
            owner = np.repeat(np.arange(len(pending)), chars)[scripts >= 0] * len(SCRIPT_NAMES) + scripts[scripts >= 0]
            letters = np.bincount(owner, minlength=len(pending) * len(SCRIPT_NAMES)).reshape(len(pending), -1)
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(lengths) - lengths])
            self.length, self.chars = np.concatenate([self.length, lengths]), np.concatenate([self.chars, chars])
            self.bytes = np.concatenate([self.bytes, ends_of(self.is_byte[flat], lengths)])
            self.letters = np.concatenate([self.letters, letters.astype(np.int32)])
            self.flat = np.concatenate([self.flat, flat])
            self.held += int(chars.sum())
            pending.clear()
        return at


@lru_cache(maxsize=2)
def fertility(path: str) -> Fertility:
    return Fertility(path)


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return len(lines) - len(set(lines))


def repeated_words(at: np.ndarray) -> int:
    """Words in 3-word windows that occur twice or more, the first occurrence included."""
    if len(at) < 4:
        return 0
    with np.errstate(over="ignore"):
        x = at.astype(np.uint64)
        # Numbers of distinct words stay below 2**21, so three of them fit into 64 bits; else they are mixed.
        small = int(at.max()) < 1 << 21
        key = x[:-2] << np.uint64(42) | x[1:-1] << np.uint64(21) | x[2:] if small else mix64(mix64(mix64(x[:-2]) + x[1:-1]) + x[2:])
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    same = ordered[1:] == ordered[:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    hit = np.zeros(len(at), bool)
    for i in range(3):
        hit[i : i + len(key)] |= twice
    return int(hit.sum())


def entropy(ids: np.ndarray) -> float:
    if not len(ids):
        return 0.0
    counts = np.unique(ids, return_counts=True)[1] if len(ids) < 2000 else np.bincount(ids)
    p = counts[counts > 0] / len(ids)
    return float(-(p * np.log2(p)).sum())


def measured(docs: DataFrame, model: str, *, least_words: int = 50, most_repeated: int = 50, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang", carry: bool = False) -> DataFrame:
    """Counts and fertility of every document; carry adds the whole document as a struct named row. No shuffle."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_memory("fertility", fertility.cache_clear)
        own = fertility(model)
        for rows, texts in array_slices(batches, "text"):
            words, at, counts = cut_words(texts)
            names = as_list(words)
            there = np.fromiter(map(bool, names), bool, len(names))[at]  # no word at the ends of white space
            sizes = ends_of(there, counts)
            at = own.number(names)[at[there]]
            tokens = own.length[at]
            ids, n = own.flat[ragged(own.start[at], tokens)], ends_of(tokens, sizes)
            chars, some = ends_of(own.chars[at], sizes), np.maximum(n, 1)
            letters = np.stack([ends_of(own.letters[at, k], sizes) for k in range(len(SCRIPT_NAMES))], 1)
            script = np.where(letters.any(1), letters.argmax(1), len(SCRIPT_NAMES) - 1)
            ends, token_ends = np.cumsum(sizes), np.cumsum(n)
            repeats = np.array([repeated_words(at[a:b]) for a, b in zip(ends - sizes, ends)], np.int64)
            bits = np.array([entropy(ids[a:b]) for a, b in zip(token_ends - n, token_ends)], float)
            columns = [
                rows.column("doc_id"),
                *map(pa.array, (sizes, chars)),
                pc.count_substring_regex(texts, SYMBOLS).cast(pa.int64()),
                pa.array([repeated_lines(t) for t in as_list(texts)], pa.int64()),
                *map(pa.array, (repeats, n, chars / some, ends_of(own.bytes[at], sizes) / some, bits)),
                pa.array([SCRIPT_NAMES[k] for k in script.tolist()], pa.string()),
                rows.column("lang"),
                pa.array((sizes < least_words) | (100 * repeats > most_repeated * sizes)),
            ]
            yield pa.RecordBatch.from_arrays([*columns, *([rows.column("row")] if carry else [])], names=schema.fieldNames())

    lang = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), lang.alias("lang"), F.col(text_col).cast("string").alias("text"), *[F.struct("*").alias("row")] * carry)
    schema = T.StructType([*T.StructType.fromDDL(", ".join(FIELDS)), *[T.StructField("row", docs.schema)] * carry])
    return rows.mapInArrow(step, schema)


def fitted_bands(rows: DataFrame, width: float, least_documents: int) -> DataFrame:
    """kind (lang or script), name and the fields of Band, from all rows of measured() that pass the base rules.

    What is shuffled is a count a bin of each name, so neither a common language nor many documents weigh on a task.
    """
    names = F.expr("array(named_struct('kind', 'lang', 'name', lang), named_struct('kind', 'script', 'name', script))")
    columns = {"chars": "chars_per_token", "bytes": "byte_share", "bits": "token_entropy"}
    values = F.expr(f"array({', '.join(f"named_struct('measure', '{m}', 'bin', floor({c} * {FLOORS[m][1]}))" for m, c in columns.items())})")
    fit = rows.where(f"not base_failed and n_tokens >= {ENTROPY_TOKENS}").select(F.explode(names).alias("of"), values.alias("values")).where("of.name is not null")
    binned = fit.select("of.*", F.explode("values").alias("v")).select("kind", "name", "v.*")
    counts = binned.groupBy("kind", "name", "measure", "bin").agg(F.count("*").alias("n"))
    quartiles = counts.groupBy("kind", "name", "measure").agg(F.sum("n").alias("documents"), F.expr("percentile(bin, array(0.25, 0.5, 0.75), n)").alias("q")).where(F.col("documents") >= least_documents)
    of = lambda measure, sign: F.max(F.when(F.col("measure") == measure, (F.get("q", F.lit(1)) + 0.5) / FLOORS[measure][1] + sign * width * F.greatest((F.get("q", F.lit(2)) - F.get("q", F.lit(0))) / FLOORS[measure][1] / 1.349, F.lit(FLOORS[measure][0]))))
    return quartiles.groupBy("kind", "name").agg(of("chars", -1).alias("least_chars"), of("chars", 1).alias("most_chars"), of("bytes", 1).alias("most_bytes"), of("bits", -1).alias("least_entropy"))


def judge_quality(
    docs: DataFrame,
    model: str,
    *,
    width: float = 5.0,
    least_documents: int = 100,
    script_bands: dict[str, Band] | None = None,
    least_words: int = 50,
    most_repeated: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str | None = "lang",
    carry: bool = False,
) -> DataFrame:
    """Counts, fertility, kept and reason (of rejection: base, chars_per_token, byte_share, token_entropy, or null) of
    every document; carry adds the whole document as a struct named row.

    The measures are written once and read twice: for the bands, and for the verdicts.
    """
    rows = stored(measured(docs, model, least_words=least_words, most_repeated=most_repeated, id_col=id_col, text_col=text_col, lang_col=lang_col, carry=carry), "measures")
    spark, fields = docs.sparkSession, list(Band.__dataclass_fields__)
    bands = stored(fitted_bands(rows, width, least_documents), "bands")
    fixed = spark.createDataFrame([(k, *map(float, asdict(b).values())) for k, b in (script_bands or SCRIPT_BANDS).items()], "name string, " + ", ".join(f"{x}_fixed double" for x in fields))
    by_script = fixed.join(bands.where("kind = 'script'"), "name", "left").select(F.col("name").alias("script"), F.struct(*(F.coalesce(x, f"{x}_fixed").alias(x) for x in fields)).alias("of_script"))
    by_lang = bands.where("kind = 'lang'").select(F.col("name").alias("lang"), F.struct(*fields).alias("of_lang"))
    by_lang = F.broadcast(by_lang) if by_lang.count() <= SENT_BANDS else by_lang
    judged = rows.join(by_lang, "lang", "left").join(F.broadcast(by_script), "script", "left").withColumn("band", F.coalesce("of_lang", "of_script"))
    outside = {
        "base": F.col("base_failed"),
        "chars_per_token": ~F.col("chars_per_token").between(F.col("band.least_chars"), F.col("band.most_chars")),
        "byte_share": F.col("byte_share") > F.col("band.most_bytes"),
        "token_entropy": (F.col("n_tokens") >= ENTROPY_TOKENS) & (F.col("token_entropy") < F.col("band.least_entropy")),
    }
    reason = F.coalesce(*(F.when(hit, F.lit(name)) for name, hit in outside.items()))
    columns = [x.split()[0] for x in FIELDS if not x.startswith("lang ")]
    return judged.withColumn("reason", reason).select(*columns, F.col("reason").isNull().alias("kept"), "reason", *["row"] * carry)
