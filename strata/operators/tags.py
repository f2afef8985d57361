"""Tags follow the data through expressions.

A column is tagged in its metadata (``policy_tag``, see ``strata.operators.project``).  Spark keeps metadata through plain
projections only; here the tags of a result's columns are derived from its analysed plan: a column that an expression,
an aggregate, a window, a join or a union computes from tagged columns has their tags.  Nothing is run and no column needs to be
named.  A node whose outputs cannot be traced (a Python or user function over whole rows) passes every tag of its inputs on.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TAG = "policy_tag"


def _seq(s) -> list:
    return [s.apply(i) for i in range(s.size())]


class _Trace:
    """Tags by expression id, from the leaves of a plan up."""

    def __init__(self):
        self.tags: dict[int, frozenset[str]] = {}
        self.by_cte: dict[int, list[frozenset[str]]] = {}

    def of(self, expression) -> frozenset[str]:
        """Tags of all that an expression refers to, plans of subqueries included."""
        name = expression.getClass().getSimpleName()
        out = self._known(expression) if name == "AttributeReference" else frozenset()
        if hasattr(expression, "plan") and "Subquery" in name or name == "Exists":
            out |= frozenset().union(*self.plan(expression.plan()))
        return out.union(*[self.of(c) for c in _seq(expression.children())])

    def _known(self, attribute) -> frozenset[str]:
        own = attribute.metadata()
        held = frozenset([own.getString(TAG)]) if own.contains(TAG) else frozenset()
        return self.tags.get(attribute.exprId().id(), frozenset()) | held

    def aliases(self, expression) -> None:
        if expression.getClass().getSimpleName() == "Alias":
            self.tags[expression.exprId().id()] = self.of(expression.child())
        for c in _seq(expression.children()):
            self.aliases(c)

    def plan(self, node) -> list[frozenset[str]]:
        """Tags of the node's output columns, in order."""
        name = node.getClass().getSimpleName()
        if name == "WithCTE":
            for d in _seq(node.cteDefs()):
                self.by_cte[d.id()] = self.plan(d.child())
            return self.plan(node.plan())
        below = [self.plan(c) for c in _seq(node.children())]
        for e in _seq(node.expressions()):
            self.aliases(e)
        out = _seq(node.output())
        if name == "CTERelationRef" and node.cteId() in self.by_cte:
            for a, t in zip(out, self.by_cte[node.cteId()]):
                self.tags[a.exprId().id()] = t
        elif name in ("Union", "Intersect", "Except"):
            for i, a in enumerate(out):
                self.tags[a.exprId().id()] = frozenset().union(*[b[i] for b in below])
        elif name == "Expand":
            columns = zip(*[_seq(p) for p in _seq(node.projections())])
            for a, column in zip(out, columns):
                self.tags[a.exprId().id()] = frozenset().union(*[self.of(e) for e in column])
        else:
            given = {a.exprId().id() for c in _seq(node.children()) for a in _seq(c.output())}
            every = frozenset().union(*[t for b in below for t in b])
            if name == "Generate":
                every = self.of(node.generator())
            for a in out:
                if a.exprId().id() not in given and a.exprId().id() not in self.tags and below:
                    self.tags[a.exprId().id()] = every
        return [self._known(a) for a in out]


def column_tags(df: DataFrame) -> list[frozenset[str]]:
    """The tags of each column of ``df``, in order: its own and those of the columns it was computed from."""
    return _Trace().plan(df._jdf.queryExecution().analyzed())


def mask_derived(df: DataFrame, allowed_tags: Sequence[str] = (), how: str = "null") -> DataFrame:
    """``df`` with every column masked that a tag reaches which is not allowed.

    ``how='null'`` puts NULL in its place, ``'hash'`` the SHA-256 of its text.
    """
    if how not in ("null", "hash"):
        raise ValueError(f"unknown masking {how!r}")
    out = []
    for i, (f, tags) in enumerate(zip(df.schema.fields, column_tags(df))):
        c = F.col(f"`{f.name}`")
        if tags - set(allowed_tags):
            c = F.sha2(c.cast("string"), 256) if how == "hash" else F.lit(None).cast(f.dataType)
        out.append(c.alias(f.name, metadata={**(f.metadata or {}), **({TAG: sorted(tags)[0]} if len(tags) == 1 else {})}))
    return df.select(*out)


def tag(df: DataFrame, tags: Mapping[str, str]) -> DataFrame:
    """``df`` with the named columns tagged."""
    for name, value in tags.items():
        df = df.withMetadata(name, {**(df.schema[name].metadata or {}), TAG: value})
    return df
