"""Spelling variants: words that are one edit apart, and the usual form of each.

Words are runs of Latin letters of all texts, counted. Whether two words are one inserted, deleted or
replaced code point apart is read off how far they agree from the front and from the back: the two
lengths together reach the longer word's length less one. If they do, one of them reaches half of the
shorter word. So words meet on their first half and on their last half, for the shorter
length that the pair would have: a pair meets on its front, or else, if its fronts differ, on its back, and
is found once.

What meets is compared in tiles: the words are rows of code-point matrices, padded behind for the
fronts and ahead for the backs, and two blocks are held against each other column by column. Small
groups are packed into a tile together; a large group is dealt to blocks, and its pairs of
blocks to as many tasks. A block holds fewer words the longer they are. Only near pairs come out.

A word's form is its most frequent near word, if that is ``ratio`` times as frequent; forms lead to a root
by doubling, as counts grow along the way.

Cases: a null or empty text has no words; a null doc_id counts as an empty one in the check value; repeated
rows count as often as they occur. Words without near ones have n_near 0, no form, and are their own root. Of
forms with equal counts the first in code-point order is taken. An empty table gives an empty result.
Other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm import common
from cohortlake.llm.common import prepare, staged

MIN_LENGTH = 5
MIN_COUNT = 3
RATIO = 2
#: A run whose check value this divides loses a code point.
DROP = 97
#: Words of a block, of which a tile holds two; words of the small groups that share a tile. A word of a large
#: group is sent once per block, so blocks are large; words of small groups meet in vain, so these are few.
BLOCK, PACK = 512, 128
#: Code points of a word that a block has room for; longer words share it.
ROOM = 32

# [A-Za-zÀ-ÿ] in UTF-8, A-Z in lower case; and the rest of a run in any case.
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
_REST = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\xbf])*+")


def runs_of(text: bytes) -> Iterator[list[bytes]]:
    """The runs of a text, ASCII letters in lower case, from pieces of bounded size that end where
    no run goes on."""
    at = 0
    while at < len(text):
        end = at + common.PIECE
        if end < len(text):
            end = _REST.match(text, end - (text[end - 1] == 0xC3)).end()
        yield _RUN.findall(text[at:end].lower())
        at = end


def changed(word: bytes, check: int) -> bytes:
    """The word without one code point, if the check value asks for it."""
    if check % DROP:
        return word
    letters = word.decode()
    at = check % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in batches:
        total: Counter[bytes] = Counter()
        ids = part.column("doc_id").to_pylist()
        for doc_id, text in zip(ids, common.as_bytes(part.column("text")), strict=True):
            start = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
            own: Counter[bytes] = Counter()
            for runs in runs_of(text):
                own.update(runs)
            for word, n in own.items():
                # a word of n code points has n to 2n bytes
                if len(word) >= MIN_LENGTH:
                    word = changed(word, zlib.crc32(word, start))
                    if len(word) - word.count(b"\xc3") >= MIN_LENGTH:
                        total[word] += n
        if total:
            words = pa.array(list(total), pa.binary()).cast(pa.string())
            yield common.batch(["word", "n"], words, pa.array(list(total.values()), pa.int64()))


def vocabulary(docs: DataFrame, least: int = MIN_COUNT) -> DataFrame:
    """(word, n): the words of at least ``MIN_LENGTH`` code points that occur ``least`` times."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    words = rows.mapInArrow(_counted, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# --- tiles --------------------------------------------------------------------------------------


class Block:
    """Words as two matrices of code points: from the front and from the back."""

    def __init__(self, words: list[str]) -> None:
        self.length = np.array([len(w) for w in words])
        flat = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        width = int(self.length.max())
        row = np.repeat(np.arange(len(words)), self.length)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(self.length) - self.length, self.length)
        self.front = np.zeros((width, len(words)), dtype=np.uint32)
        self.front[place, row] = flat
        self.back = np.zeros((width, len(words)), dtype=np.uint32)
        self.back[np.repeat(self.length, self.length) - 1 - place, row] = flat


def _agreeing(one: np.ndarray, other: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """How many columns agree from the first one on, for every wanted pair of rows."""
    alive, length = wanted.copy(), np.zeros(wanted.shape, dtype=np.int32)
    for a, b in zip(one, other, strict=False):
        alive &= a[:, None] == b[None, :]
        if not alive.any():
            break
        length += alive
    return length


def near_in_tile(
    left: Block, right: Block, wanted: np.ndarray, half: np.ndarray, back: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the wanted pairs that are one edit apart. ``half`` is how far the words of a row of
    ``left`` must agree where they meet, ``back`` whether they met there on their backs: then
    pairs that meet on their fronts as well are left out."""
    longer = np.maximum(left.length[:, None], right.length[None, :])
    shorter = np.minimum(left.length[:, None], right.length[None, :])
    front = np.minimum(_agreeing(left.front, right.front, wanted), shorter)
    wanted = wanted & ((front >= half[:, None]) != back[:, None])
    if not wanted.any():
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    tail = np.minimum(_agreeing(left.back, right.back, wanted), shorter)
    return np.nonzero(wanted & (front + tail >= longer - 1))


CELL = ["shorter", "key", "i", "j"]


def _cells(rows: pa.Table | pa.RecordBatch) -> np.ndarray:
    """The number of each row's cell, for rows sorted by cell."""
    keys = np.stack([rows.column(c).to_numpy() for c in CELL], axis=1)
    return np.concatenate(([0], np.cumsum((keys[1:] != keys[:-1]).any(axis=1))))


def _whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The sorted rows as tables that end where a cell ends."""
    held: list[pa.RecordBatch] = []
    for part in batches:
        if not part.num_rows:
            continue
        cell = _cells(part)
        cut = int(np.searchsorted(cell, cell[-1]))
        ends = held and held[-1].select(CELL).slice(held[-1].num_rows - 1) != part.select(CELL).slice(0, 1)
        if cut or ends:
            yield pa.Table.from_batches([*held, part.slice(0, cut)])
            held = []
        held.append(part.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _tiles(cell: np.ndarray, shorter: np.ndarray, pair: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cut rows into tiles: a cell of two blocks, or as many other cells as there is room for. Words
    come by length, so those that follow are hardly longer."""
    cuts = np.append(np.flatnonzero(np.diff(cell, prepend=-1)), len(cell))
    at = 0
    while at < len(cuts) - 1:
        end = at + 1
        most = PACK * ROOM // max(int(shorter[cuts[at]]), ROOM)
        if not pair[cuts[at]]:
            while end < len(cuts) - 1 and not pair[cuts[end]] and cuts[end + 1] - cuts[at] <= most:
                end += 1
        yield int(cuts[at]), int(cuts[end])
        at = end


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _whole_cells(batches):
        words, cell = rows["word"].to_pylist(), _cells(rows)
        counts, block, i, j, shorter, back = (
            rows[c].to_numpy() for c in ("n", "block", "i", "j", "shorter", "back")
        )
        for lo, hi in _tiles(cell, shorter, i != j):
            at = np.arange(lo, hi)
            left, right = at[block[lo:hi] == i[lo:hi]], at[block[lo:hi] == j[lo:hi]]
            if not len(left) or not len(right):
                continue
            pair = i[lo] != j[lo]
            one = Block([words[k] for k in left])
            other = Block([words[k] for k in right]) if pair else one
            # at least one of the two has the shorter length
            wanted = (one.length == shorter[left])[:, None] | (other.length == shorter[right])[None, :]
            wanted &= cell[left][:, None] == cell[right][None, :]
            if not pair:
                wanted = np.triu(wanted, 1)
            a, b = near_in_tile(one, other, wanted, shorter[left] // 2, back[left])
            if len(a):
                a, b = left[a], right[b]
                yield common.batch(
                    ["a", "n_a", "b", "n_b"],
                    pa.array([words[k] for k in a], pa.string()), counts[a],
                    pa.array([words[k] for k in b], pa.string()), counts[b],
                )


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): every pair of words one edit apart, once, from distinct words (word, n)."""
    length = F.length("word")
    half = F.floor(F.col("shorter") / 2).cast("int")
    sides = F.array(F.lit(False), F.lit(True))
    part = F.when(F.col("back"), F.expr("right(word, half)")).otherwise(F.expr("left(word, half)"))
    meeting = (
        words.withColumn("length", length)
        .withColumn("shorter", F.explode(F.array(F.col("length"), F.col("length") - 1)))
        .where("shorter > 0")
        .withColumn("half", half)
        .withColumn("back", F.explode(sides))
        .withColumn("key", F.xxhash64("shorter", "back", part))
        .select("word", "n", "length", "shorter", "back", "key")
    )
    groups = (
        meeting.groupBy("key", "shorter")
        .agg(
            F.count("*").alias("words"),
            F.count_if(F.col("length") == F.col("shorter")).alias("short"),
        )
        .where("words > 1 AND short > 0")
        .select(
            "key",
            "shorter",
            F.ceil(F.col("words") * F.greatest(F.col("shorter"), F.lit(ROOM)) / (BLOCK * ROOM))
            .cast("int")
            .alias("blocks"),
        )
    )
    cells = (
        meeting.join(groups, ["key", "shorter"])
        .withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
        .select("word", "n", "shorter", "back", "key", "block", "i", "j")
    )
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cells.repartition(parts, *CELL).sortWithinPartitions(*CELL)
    return dealt.mapInArrow(_near, "a string, n_a long, b string, n_b long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the last word that forms lead to, which has none itself. Each
    round doubles the steps taken; counts grow along the way, so there are no circles."""
    found = staged(forms.select("word", F.col("form").alias("root")))
    while True:
        further = found.select(F.col("word").alias("root"), F.col("root").alias("end"))
        found = staged(
            found.join(further, "root", "left").select(
                "word", F.coalesce("end", "root").alias("root"), F.col("end").isNotNull().alias("moved")
            )
        )
        if found.where("moved").isEmpty():
            return found.drop("moved")
        found = found.drop("moved")


def spelling_variants(docs: DataFrame, least: int = MIN_COUNT, ratio: float = RATIO) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n."""
    prepare(docs.sparkSession)
    words = staged(vocabulary(docs, least))
    pairs = staged(near_pairs(words))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("n_other"))
    both = both.unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("n_other"))
    )
    best = F.min(F.struct((-F.col("n_other")).alias("less"), F.col("other").alias("form")))
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    usual = -F.col("best.less") >= ratio * F.col("n")
    told = staged(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(usual, F.col("best.form")).alias("form"),
            F.when(usual, -F.col("best.less")).alias("form_n"),
        )
    )
    ends = roots(told.where("form IS NOT NULL"))
    return told.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


#: The same from single deletions and words with one code point masked, in another engine's words.
SQL = rf"""
WITH RECURSIVE {common.CRC_TABLE_SQL},
runs AS (
  SELECT doc_id, unnest(regexp_extract_all({common.lower_sql("text")}, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run
  FROM documents),
checked AS (
  SELECT run, n, {common.crc_sql("name")} AS h, bits
  FROM (SELECT run, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS name, count(*) AS n
        FROM runs GROUP BY ALL), bits),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT n, CASE WHEN h % 97 = 0
          THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
        FROM checked)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (
  SELECT word, n, substr(word, 1, i) || '_' || substr(word, i + 2) AS masked,
         substr(word, 1, i) || substr(word, i + 2) AS shorter
  FROM (SELECT *, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b USING (masked) WHERE a.word <> b.word
  UNION SELECT cut.word, words.word, words.n FROM cut JOIN words ON cut.shorter = words.word
  UNION SELECT words.word, cut.word, cut.n FROM cut JOIN words ON cut.shorter = words.word),
best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-n, other)) AS form, max(n) AS form_n
  FROM near GROUP BY word),
told AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN form_n >= 2 * words.n THEN form END AS form,
         CASE WHEN form_n >= 2 * words.n THEN form_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
steps AS (
  SELECT word, word AS root FROM told
  UNION ALL SELECT steps.word, told.form FROM steps JOIN told ON steps.root = told.word
  WHERE told.form IS NOT NULL)
SELECT told.word, told.form, steps.root, told.n, told.n_near, told.form_n
FROM told JOIN steps USING (word) JOIN told AS last ON steps.root = last.word
WHERE last.form IS NULL
"""
