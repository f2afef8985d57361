"""Fill-in-middle: texts cut in prefix, middle and suffix at unit ranks, found with an indexable skip list.

A text's units are its lines. ``SkipList`` holds them with express lanes: every ``FAN``-th node of a lane is
a node of the next, and each link carries two widths, how many units and how many code points it passes.
Descending from the top lane, a link is taken as long as the units passed stay within the rank, so the
widths add up to the exact code point at which to cut, in steps that grow with the logarithm of the text.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strata.llm.common import give_back, pick, table

# Fixed values of the contract.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, RATE, SPM = "7", 100, 50
UNIT = re.compile(r"[^\n]*\n|[^\n]+")
FAN = 8


class SkipList:
    """Units by rank. ``lanes[0]`` links unit to unit; a link of lane k passes ``fan ** k`` units (the last one fewer).

    Each lane is a list of (units, code points) widths, one a link.
    """

    def __init__(self, widths: list[int], fan: int = FAN):
        self.fan, self.n = fan, len(widths)
        self.lanes = [[(1, w) for w in widths]]
        while len(self.lanes[-1]) > fan:
            low = self.lanes[-1]
            self.lanes.append([(sum(u for u, _ in low[i:i + fan]), sum(c for _, c in low[i:i + fan])) for i in range(0, len(low), fan)])

    def locate(self, rank: int) -> int:
        """The code point at which unit ``rank`` begins; the text's end for ``rank`` = number of units."""
        if not 0 <= rank <= self.n:
            raise IndexError(rank)
        units = points = node = 0
        for lane in reversed(self.lanes):
            node *= self.fan  # the same place, one lane down
            while node < len(lane) and units + lane[node][0] <= rank:
                units, points, node = units + lane[node][0], points + lane[node][1], node + 1
        return points


def draws(doc_id: int | None, seed: str = SEED) -> list[int]:
    """h1 to h4: the first four groups of eight digits of the hex sha256 of the seed and the id."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(h[i:i + 8], 16) for i in (0, 8, 16, 24)]


def transform(doc_id: int | None, text: str, seed: str = SEED, rate: int = RATE, spm: int = SPM) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, code points of the prefix, of the middle, output) of one text."""
    units = SkipList([len(u) for u in UNIT.findall(text)])
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= rate:
        return units.n, "plain", None, None, text
    a, z = sorted((units.locate(h1 % (units.n + 1)), units.locate(h2 % (units.n + 1))))
    if h4 % 100 < spm:
        return units.n, "spm", a, z - a, SUFFIX + text[z:] + PREFIX + text[:a] + MIDDLE + text[a:z]
    return units.n, "psm", a, z - a, PREFIX + text[:a] + SUFFIX + text[z:] + MIDDLE + text[a:z]


def restore(form: str, output: str) -> str:
    """The text that an output was made of. The signs part it: no transformed text holds one of its own."""
    if form == "plain":
        return output
    if form not in ("psm", "spm"):
        raise ValueError(f"no such form: {form}")
    one, two = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    if not output.startswith(one):
        raise ValueError(f"no {one} at the start")
    at = output.index(two, len(one))
    end = output.index(MIDDLE, at + len(two))
    first, second, middle = output[len(one):at], output[at + len(two):end], output[end + len(MIDDLE):]
    return first + middle + second if form == "psm" else second + middle + first


def fill_in_middle(docs: DataFrame, key: str = "doc_id", seed: str = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """(``key``, n, form, prefix_chars, middle_chars, output) of every row of ``docs``, which has ``key`` (an integer) and text.

    ``rate`` per cent of the texts are cut, ``spm`` per cent of these in suffix-prefix-middle order. A null text
    counts as empty and stays plain; a null key draws as an empty one; repeated rows get equal cuts; an empty
    table gives none; other columns are not read. Texts are taken one by one, whatever their length.
    """
    def run(batches):
        for b in batches:
            give_back()
            held, rows = 0, []
            for i in range(b.num_rows):
                doc = b.column(0)[i].as_py()
                rows.append((doc, *transform(doc, b.column(1)[i].as_py() or "", seed, rate, spm)))
                held += len(rows[-1][-1])
                if held > 4 << 20 or i == b.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                    held, rows = 0, []

    names, types = ["key", "n", "form", "prefix_chars", "middle_chars", "output"], [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    schema = StructType([StructField(n, LongType() if t == pa.int64() else StringType()) for n, t in zip(names, types)])
    rows = pick(docs, key, "text").select(F.col(f"`{key}`").cast("long"), "text")
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def restored(cut: DataFrame) -> DataFrame:
    """``cut`` with ``restored``: each row's text, rebuilt from its output and form alone."""
    def run(batches):
        for b in batches:
            give_back()
            form, output = b.column(b.schema.get_field_index("form")), b.column(b.schema.get_field_index("output"))
            for i in range(0, b.num_rows, 200):  # a few texts at a time
                part = [restore(f.as_py(), o.as_py()) for f, o in zip(form.slice(i, 200), output.slice(i, 200))]
                yield pa.RecordBatch.from_arrays([*b.slice(i, 200).columns, pa.array(part, pa.string())], names=[*b.schema.names, "restored"])

    return cut.mapInArrow(run, StructType([*cut.schema.fields, StructField("restored", StringType())]))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    sha = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return restored(fill_in_middle(table(spark, sf_dir, "documents"))).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", sha("output").alias("output_sha256"), sha("restored").alias("restored_sha256"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
         sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
h AS (
  SELECT doc_id, t, u, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM d),
c AS (
  SELECT doc_id, t, n,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(u[1:least(h1 % (n + 1), h2 % (n + 1))], '') AS pre,
         array_to_string(u[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') AS mid,
         array_to_string(u[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:], '') AS suf
  FROM h)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(pre)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN t ELSE pre || mid || suf END) AS restored_sha256
FROM c
"""
