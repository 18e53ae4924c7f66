"""Conjunctive patterns over customers, orders, suppliers and places, by semi-join reduction."""

from __future__ import annotations

from pyspark.sql import functions as F

from textkg.operators import graph as gr
from textkg.operators import patterns as pt
from textkg.plans import views as v
from textkg.plans.catalog import query
from textkg.plans.q_graph import _ALL_TYPES, _KG, _all_types

_DEALS = (
    _KG
    + """, dl AS (SELECT * FROM kg UNION ALL SELECT 'order:' || l_orderkey, 'suppliedBy', 'supplier:' || l_suppkey FROM lineitem
  UNION ALL SELECT 'customer:' || o_custkey, 'ordersAt', o_orderpriority FROM orders)"""
)

# who in region 2 orders from whom in region 1
_TRADE = [
    ("?q", "placedBy", "?c"), ("?c", "inNation", "?n"), ("?n", "inRegion", "region:2"),
    ("?q", "suppliedBy", "?s"), ("?s", "inNation", "?m"), ("?m", "inRegion", "region:1"),
]
_TRADE_SQL = f"""{_DEALS}, tr AS (SELECT DISTINCT q.s AS q, q.o AS c, n.o AS n, x.o AS s, m.o AS m FROM dl q
  JOIN dl n ON n.s = q.o AND n.p = 'inNation' JOIN dl r ON r.s = n.o AND r.p = 'inRegion' AND r.o = 'region:2'
  JOIN dl x ON x.s = q.s AND x.p = 'suppliedBy' JOIN dl m ON m.s = x.o AND m.p = 'inNation'
  JOIN dl g ON g.s = m.o AND g.p = 'inRegion' AND g.o = 'region:1' WHERE q.p = 'placedBy')"""


def deals(spark, sf):
    """kg with the suppliers of each order and the priorities each customer orders at."""
    supplied = v.table(spark, sf, "lineitem").select(
        F.concat(F.lit("order:"), "l_orderkey").alias("s"), F.lit("suppliedBy").alias("p"), F.concat(F.lit("supplier:"), "l_suppkey").alias("o")
    )
    priorities = v.table(spark, sf, "orders").select(
        F.concat(F.lit("customer:"), "o_custkey").alias("s"), F.lit("ordersAt").alias("p"), F.col("o_orderpriority").alias("o")
    )
    return v.kg(spark, sf).unionByName(supplied).unionByName(priorities)


@query("pattern_solutions", f"WITH {_TRADE_SQL} SELECT q, c, n, s, m FROM tr")
def pattern_solutions(spark, sf):
    return pt.solutions(deals(spark, sf), _TRADE)


@query("pattern_projected", f"WITH {_TRADE_SQL} SELECT DISTINCT c, m FROM tr")
def pattern_projected(spark, sf):
    return pt.solutions(deals(spark, sf), _TRADE, ["c", "m"])


@query(
    "pattern_cycle",
    f"""WITH {_DEALS} SELECT DISTINCT q.s AS q, x.o AS s FROM dl q JOIN dl n ON n.s = q.o AND n.p = 'inNation'
    JOIN dl x ON x.s = q.s AND x.p = 'suppliedBy' JOIN dl m ON m.s = x.o AND m.p = 'inNation' AND m.o = n.o WHERE q.p = 'placedBy'""",
)
def pattern_cycle(spark, sf):
    """Orders with a supplier of the customer's own nation."""
    patterns = [("?q", "placedBy", "?c"), ("?c", "inNation", "?n"), ("?q", "suppliedBy", "?s"), ("?s", "inNation", "?n")]
    return pt.solutions(deals(spark, sf), patterns, ["q", "s"])


def _counted(name: str, prop: str, where: str, kept: str) -> str:
    said = " ".join(next(p for p in _TRADE if " ".join(p) == name))
    return f"SELECT '{said}' AS pattern, (SELECT count(*) FROM dl WHERE p = '{prop}'{where}) AS n_rows, (SELECT count(DISTINCT {kept}) FROM tr) AS n_kept"


@query(
    "pattern_reduction",
    f"WITH {_TRADE_SQL} "
    + " UNION ALL ".join(
        [
            _counted("?q placedBy ?c", "placedBy", "", "(q, c)"),
            _counted("?c inNation ?n", "inNation", "", "(c, n)"),
            _counted("?n inRegion region:2", "inRegion", " AND o = 'region:2'", "n"),
            _counted("?q suppliedBy ?s", "suppliedBy", "", "(q, s)"),
            _counted("?s inNation ?m", "inNation", "", "(s, m)"),
            _counted("?m inRegion region:1", "inRegion", " AND o = 'region:1'", "m"),
        ]
    ),
)
def pattern_reduction(spark, sf):
    """Rows of each pattern before the reduction, and those left after it: exactly the ones that solutions use."""
    return pt.reduction_report(pt.reduce_patterns(deals(spark, sf), _TRADE), _TRADE)


@query(
    "class_two_restrictions",
    f"""WITH RECURSIVE {_ALL_TYPES}, {_DEALS} SELECT ind FROM aty WHERE class = 'Customer'
    AND ind IN (SELECT s FROM dl WHERE p = 'inNation' AND o = 'nation:3') AND ind IN (SELECT s FROM dl WHERE p = 'ordersAt' AND o LIKE '1-%')""",
)
def class_two_restrictions(spark, sf):
    """Customers of a nation who have ordered at the highest priority."""
    return gr.class_intersection(
        _all_types(spark, sf), deals(spark, sf), "Customer", [("inNation", "nation:3"), ("ordersAt", "1-URGENT")]
    )
