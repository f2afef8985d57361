"""Rule validation with two outputs (valid rows + rule audit).

Rules are text.  They are compiled once on the driver into Spark ``Column``
expressions; every row is then judged inside whole-stage codegen, in one
pass that builds ``ARRAY<STRUCT<rule_id, passed, error_message>>``.  The valid
output keeps rows where every (rejecting) rule passed, the audit output is
``inline`` of that array -- one row per (row, rule).  Nothing is shuffled.

Two modes:

``compat``
    The loose text evaluator of the bulk loader, reproduced rule for rule
    (including its quirks: ``IS NOT NULL`` ignores what follows it, an
    ``x IS NULL OR ...`` rule always passes, ``!=`` compares against the
    literal text when a side is not a column, ``COUNT(`` rules are skipped,
    anything it cannot read passes).  Rows are all-string, missing = ``''``.
``strict``
    The rule text is Spark SQL (``REGEXP_CONTAINS`` is mapped to
    ``regexp_like``), ``''`` counts as NULL, a NULL result fails, and only
    ``severity == 'reject'`` rules drop a row.
"""

from __future__ import annotations

import re
import uuid as _uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.numbers import NUMBER
from strata.session import cut_lineage

# Audit messages of the compat evaluator.
MSG_SKIPPED_AGG = "Skipped aggregation rule evaluation in single-row context"
MSG_TOO_COMPLEX = "Rule too complex for simple evaluator, defaulted to PASS"
MSG_NOT_NULL = "{col} is null but required not to be"
MSG_OR = "Failed OR condition: {expr}"
MSG_NE = "{a} ({va}) == {b} ({vb})"
MSG_GE = "{col} ({v}) < {val}"
MSG_GT = "{col} ({v}) <= {val}"
MSG_TYPE_GE = "Type mismatch for >="
MSG_TYPE_GT = "Type mismatch for >"
MSG_IN = "{col} ({v}) not in {values}"
# Audit statuses.
PASS, FAIL, WARN = "PASS", "FAIL", "WARN"

AUDIT_SCHEMA = T.StructType([
    T.StructField("audit_id", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("row_key", T.StringType()),
    T.StructField("rule_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("evaluated_at", T.TimestampType()),
])


@dataclass(frozen=True)
class Rule:
    id: str
    expression: str
    field: str | None = None
    severity: str = "reject"

    @staticmethod
    def of(d) -> "Rule":
        if isinstance(d, Rule):
            return d
        return Rule(d.get("id", "UNKNOWN"), d.get("expression", ""), d.get("field"),
                    d.get("severity", "reject"))


# ---------------------------------------------------------------- compat ---

def _value(columns: set[str], name: str) -> Column:
    """Row value of ``name`` or, when it is not a column, the literal text."""
    return F.col(name) if name in columns else F.lit(name)


def _nonempty(c: Column) -> Column:
    return c.isNotNull() & (c != F.lit(""))


def _text(c: Column) -> Column:
    """Message rendering of a row value (missing -> 'None')."""
    return F.coalesce(c.cast("string"), F.lit("None"))


def _fmt(template: str, **parts) -> Column:
    """``template`` with ``{name}`` filled by Columns or plain strings."""
    pieces: list[Column] = []
    pos = 0
    for m in re.finditer(r"\{(\w+)\}", template):
        if m.start() > pos:
            pieces.append(F.lit(template[pos:m.start()]))
        v = parts[m.group(1)]
        pieces.append(v if isinstance(v, Column) else F.lit(str(v)))
        pos = m.end()
    if pos < len(template):
        pieces.append(F.lit(template[pos:]))
    return F.concat(*pieces) if pieces else F.lit("")


# Marks of the loose rule language, found in one pass over the text. A word mark needs blanks around it, in any case.
_MARK = re.compile(r"(?P<count>COUNT\()|(?P<required> IS NOT NULL)|(?P<optional> IS NULL)|(?P<either> OR(?= ))"
                   r"|(?P<differs>!=)|(?P<least>>=)|(?P<above>>)|(?P<listed> IN(?= ))", re.IGNORECASE)


@dataclass(frozen=True)
class _Marked:
    """A rule's text, the places of its marks by kind, and the columns it may name."""
    text: str
    marks: dict[str, list[re.Match]]
    columns: frozenset[str]

    @staticmethod
    def read(text: str | None, columns: Iterable[str]) -> _Marked:
        text, marks = (text or "").strip(), {}
        for m in _MARK.finditer(text):
            marks.setdefault(m.lastgroup, []).append(m)
        return _Marked(text, marks, frozenset(columns))

    def parts(self, kind: str) -> list[str]:
        """The text between the marks of one kind."""
        edges = [(0, 0), *(m.span() for m in self.marks[kind]), (len(self.text), 0)]
        return [self.text[a[1]:b[0]].strip() for a, b in zip(edges, edges[1:])]

    def sides(self, kind: str) -> tuple[str, str]:
        """Left and right of the one mark of a kind; more than one is an error."""
        left, right = self.parts(kind)
        return left, right

    def subject(self, kind: str) -> str:
        """What stands before the first mark; the whole text unless the mark is in capitals."""
        first = self.marks[kind][0]
        return self.parts(kind)[0] if first.group().isupper() else self.text


_Judged = tuple[Column, Column]


def _judged(ok: Column, message: Column) -> _Judged:
    return ok, F.when(ok, F.lit("")).otherwise(message)


def _required(r: _Marked) -> _Judged:
    col = r.subject("required")
    ok = _nonempty(F.col(col)) if col in r.columns else F.lit(False)
    return _judged(ok, F.lit(MSG_NOT_NULL.format(col=col)))


def _optional(r: _Marked) -> _Judged:
    col = r.subject("optional")
    if col not in r.columns:
        return F.lit(True), F.lit("")
    ok, message = _by_marks(r, after="optional")
    return _judged(~_nonempty(F.col(col)) | ok, message)


def _either(r: _Marked) -> _Judged:
    return _judged(reduce(Column.__or__, [compile_compat(p, r.columns)[0] for p in r.parts("either")]), F.lit(MSG_OR.format(expr=r.text)))


def _differs(r: _Marked) -> _Judged:
    a, b = r.sides("differs")
    va, vb = _value(r.columns, a), _value(r.columns, b)
    return _judged(~va.eqNullSafe(vb), _fmt(MSG_NE, a=a, va=_text(va), b=b, vb=_text(vb)))


def _bounded(kind: str, holds, failed: str, mismatch: str):
    def form(r: _Marked) -> _Judged | None:
        col, bound = r.sides(kind)
        if col not in r.columns:
            return None  # not a comparison this language knows: later forms may read it
        try:
            limit = F.lit(float(bound))
        except ValueError:
            return F.lit(False), F.lit(mismatch)
        number = F.when(F.col(col).cast("string").rlike(NUMBER), F.expr(f"try_cast(`{col}` AS DOUBLE)"))
        ok = F.coalesce(~F.isnan(number) & holds(number, limit), F.lit(False))
        return _judged(ok, F.when(number.isNull(), F.lit(mismatch)).otherwise(_fmt(failed, col=col, v=_text(F.col(col)), val=bound)))
    return form


def _listed(r: _Marked) -> _Judged:
    col, listed = r.sides("listed")
    values = [re.sub(r"""^\s*'*"*|"*'*\s*$""", "", v) for v in listed.strip("()").split(",")]
    known = col in r.columns
    ok = F.coalesce(F.col(col).isin(values), F.lit(False)) if known else F.lit(False)
    return _judged(ok, _fmt(MSG_IN, col=col, v=_text(F.col(col)) if known else "None", values="[" + ", ".join(map(repr, values)) + "]"))


# The forms of a rule in the order in which they are looked for; the first that reads the rule judges it.
_FORMS = {
    "count": lambda r: (F.lit(True), F.lit(MSG_SKIPPED_AGG)),
    "required": _required, "optional": _optional, "either": _either, "differs": _differs,
    "least": _bounded("least", Column.__ge__, MSG_GE, MSG_TYPE_GE),
    "above": lambda r: None if "least" in r.marks else _bounded("above", Column.__gt__, MSG_GT, MSG_TYPE_GT)(r),
    "listed": _listed,
}


def _by_marks(r: _Marked, after: str | None = None) -> _Judged:
    """The first form, of those that come after ``after``, whose mark the text has and that reads it."""
    kinds = list(_FORMS)
    for kind in kinds[kinds.index(after) + 1 if after else 0:]:
        if kind in r.marks and (judged := _FORMS[kind](r)) is not None:
            return judged
    return F.lit(True), F.lit(MSG_TOO_COMPLEX)


def compile_compat(expression: str, columns: Iterable[str]) -> tuple[Column, Column]:
    """Compile one rule in compat mode to ``(passed, message)`` Columns."""
    return _by_marks(_Marked.read(expression, columns))


# ---------------------------------------------------------------- strict ---

_RAW_STRING = re.compile(r"""\br'((?:[^'\\]|\\.)*)'""")


def to_spark_sql(expression: str) -> str:
    """Map the rule dialect to Spark SQL (REGEXP_CONTAINS, r'...' literals)."""
    text = re.sub(r"\bREGEXP_CONTAINS\s*\(", "regexp_like(", expression, flags=re.IGNORECASE)
    return _RAW_STRING.sub(lambda m: "'" + m.group(1).replace("\\", "\\\\") + "'", text)


def compile_strict(expression: str) -> tuple[Column, Column]:
    ok = F.coalesce(F.expr(to_spark_sql(expression)), F.lit(False))
    return ok, F.when(ok, F.lit("")).otherwise(F.lit(f"Rule failed: {expression}"))


def blank_to_null(df: DataFrame) -> DataFrame:
    """``''`` -> NULL on string columns (strict-mode view of a bulk-load row)."""
    return df.select(*[
        F.when(F.col(f.name) == "", F.lit(None)).otherwise(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields])


def as_text(df: DataFrame) -> DataFrame:
    """Bulk-load row view: every column a string, missing = ``''``."""
    return df.select(*[
        F.coalesce(F.col(f.name).cast("string"), F.lit("")).alias(f.name)
        if not isinstance(f.dataType, T.StringType)
        else F.coalesce(F.col(f.name), F.lit("")).alias(f.name)
        for f in df.schema.fields])


# ------------------------------------------------------------- validate ---

@dataclass
class Validation:
    valid: DataFrame
    audit: DataFrame
    evaluated: DataFrame


def evaluate(df: DataFrame, rules: Sequence, mode: str = "compat") -> DataFrame:
    """Attach ``_results ARRAY<STRUCT<rule_id, passed, reject, error_message>>``."""
    rules = [Rule.of(r) for r in rules]
    base = blank_to_null(df) if mode == "strict" else as_text(df)
    structs = []
    for r in rules:
        if mode == "compat":
            ok, msg = compile_compat(r.expression, df.columns)
            reject = True  # severity is not read in compat mode
        elif mode == "strict":
            ok, msg = compile_strict(r.expression)
            reject = (r.severity or "reject").lower() == "reject"
        else:
            raise ValueError(f"unknown rule mode {mode!r}")
        structs.append(F.struct(F.lit(r.id).alias("rule_id"), ok.alias("passed"),
                                F.lit(reject).alias("reject"),
                                msg.alias("error_message")))
    results = F.array(*structs) if structs else F.array().cast(
        "array<struct<rule_id:string,passed:boolean,reject:boolean,error_message:string>>")
    return base.withColumn("_results", results)


def validate(df: DataFrame, table_name: str, rules: Sequence, mode: str = "compat",
             key: str | Column | None = None, audit_id: str = "uuid",
             run_id: str | None = None, evaluated_at: datetime | None = None,
             carry: Sequence[str] = (), materialize: bool = False) -> Validation:
    """V1: split ``df`` into rows passing every rule and one audit row per rule.

    ``key`` is the audit ``row_key`` (default: the first column, as text).
    ``audit_id='uuid'`` draws ``uuid()``; ``'hash'`` derives a stable id from
    (run, table, row key, rule, row content) so that a recomputed partition --
    e.g. after an executor loss -- writes identical audit rows.
    ``evaluated_at`` is one literal time per run, fixed on the driver, so both
    outputs and any retried task agree on it.  ``carry`` copies extra columns
    onto the audit rows.

    ``materialize`` evaluates the rules once into the shared checkpoint folder
    (a reliable ``checkpoint``, see ``strata.session.cut_lineage``); both
    outputs then read that copy instead of scanning and evaluating the source
    twice, and a lost executor recomputes from the copy, not from the source.
    """
    run_id = run_id or _uuid.uuid4().hex
    when = evaluated_at or datetime.now(timezone.utc).replace(tzinfo=None)
    cols = df.columns
    if key is None:
        key_col = F.col(cols[0]).cast("string") if cols else F.lit("unknown")
    elif isinstance(key, str):
        key_col = F.col(key).cast("string")
    else:
        key_col = key
    rules = [Rule.of(r) for r in rules]
    evaluated = evaluate(df, rules, mode)
    if materialize:
        evaluated = cut_lineage(evaluated)
    valid = evaluated.filter(
        F.forall("_results", lambda r: r["passed"] | ~r["reject"])).select(*cols)

    row_fp = F.xxhash64(*[F.col(c) for c in cols]) if cols else F.lit(0)
    # inline_outer: the array always holds one struct per rule, and plain
    # inline would make Catalyst infer a size(...) > 0 filter that evaluates
    # every rule a second time below the scan.
    audit = evaluated.select(
        key_col.alias("row_key"), row_fp.alias("_fp"), *[F.col(c) for c in carry],
        F.inline_outer("_results"))
    if not rules:
        audit = audit.limit(0)
    if audit_id == "hash":
        aid = F.sha2(F.concat_ws("|", F.lit(run_id), F.lit(table_name), F.col("row_key"),
                                 F.col("rule_id"), F.col("_fp").cast("string")), 256)
    else:
        aid = F.expr("uuid()")
    audit = audit.select(
        aid.alias("audit_id"), F.lit(table_name).alias("table_name"),
        F.col("row_key"), F.col("rule_id"),
        F.when(F.col("passed"), F.lit(PASS)).otherwise(F.lit(FAIL)).alias("status"),
        F.col("error_message"),
        F.lit(when).cast("timestamp").alias("evaluated_at"),
        *[F.col(c) for c in carry])
    return Validation(valid, audit, evaluated)


def flatten_audits(audits: Iterable[DataFrame]) -> DataFrame:
    """Union of per-table audit outputs, duplicates kept."""
    audits = list(audits)
    if not audits:
        raise ValueError("no audit streams")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), audits)
