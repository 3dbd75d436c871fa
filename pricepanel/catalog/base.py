"""Registered queries and the SQL that must give the same rows.

``@query(name, sql=..., uses=[...])`` registers a callable ``(spark, root)``.
``uses`` lists shared table expressions of ``VIEWS`` the SQL refers to; their
own dependencies are added automatically.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# name -> (dependencies, body); dependencies precede the body in the WITH list.
VIEWS: dict[str, tuple[list[str], str]] = {
    "comp": (
        [],
        """SELECT o_orderpriority AS entity, CAST(o_orderdate AS DATE) AS obs_date,
                  min(o_totalprice) AS price,
                  avg(CASE WHEN o_orderstatus = 'O' THEN 1.0 ELSE 0.0 END) AS available
           FROM orders GROUP BY 1, 2""",
    ),
    "focal_rows": (
        [],
        """SELECT CAST(l_shipdate AS DATE) AS obs_date, l_returnflag AS segment,
                  l_extendedprice / l_quantity AS price FROM lineitem""",
    ),
    "focal": (
        ["focal_rows"],
        "SELECT obs_date, min(price) AS base_rate FROM focal_rows GROUP BY 1",
    ),
    "comp_dates": (
        ["comp"],
        """SELECT CAST(unnest(generate_series(min(obs_date), max(obs_date), INTERVAL 1 DAY)) AS DATE)
                  AS obs_date FROM comp""",
    ),
    "comp_dense": (
        ["comp", "comp_dates"],
        """SELECT e.entity, d.obs_date, c.price, c.available
           FROM (SELECT DISTINCT entity FROM comp) e, comp_dates d
           LEFT JOIN comp c ON c.entity = e.entity AND c.obs_date = d.obs_date""",
    ),
    "nations": (
        [],
        """SELECT n_nationkey, n_regionkey, n_name AS name,
                  CASE WHEN n_regionkey = 4 THEN 'EUR' ELSE 'USD' END AS currency FROM nation""",
    ),
    "portfolio": (
        ["nations"],
        """SELECT n.name AS focal_id, CAST(o_orderdate AS DATE) AS obs_date,
                  min(o_totalprice) AS base_rate
           FROM orders JOIN customer ON o_custkey = c_custkey
           JOIN nations n ON c_nationkey = n.n_nationkey GROUP BY 1, 2""",
    ),
    "region_panel": (
        ["portfolio"],
        """SELECT f.name AS focal_id, e.name AS entity, e.currency, p.obs_date, p.base_rate AS price
           FROM nations f JOIN nations e ON f.n_regionkey = e.n_regionkey AND f.name <> e.name
           JOIN portfolio p ON p.focal_id = e.name""",
    ),
    "registry": (
        [],
        "SELECT n_name AS focal_id FROM nation UNION ALL SELECT 'NATION_WITHOUT_DATA'",
    ),
    "hourly": (
        [],
        """SELECT event_type AS entity, date_trunc('hour', ts) AS obs_hour, avg(value) AS price
           FROM events GROUP BY 1, 2""",
    ),
    "hourly_dense": (
        ["hourly"],
        """SELECT e.entity, h.obs_hour, p.price FROM (SELECT DISTINCT entity FROM hourly) e,
           (SELECT unnest(generate_series(min(obs_hour), max(obs_hour), INTERVAL 1 HOUR)) AS obs_hour
            FROM hourly) h
           LEFT JOIN hourly p ON p.entity = e.entity AND p.obs_hour = h.obs_hour""",
    ),
    "masked": (
        ["comp"],
        """SELECT entity, obs_date, price AS truth,
                  CASE WHEN (dayofyear(obs_date) * 7 + length(entity)) % 10 = 0 THEN NULL
                       ELSE price END AS price FROM comp""",
    ),
}


def _ordered(names: list[str], seen: list[str]) -> list[str]:
    for name in names:
        _ordered(VIEWS[name][0], seen)
        if name not in seen:
            seen.append(name)
    return seen


def with_views(names: list[str], body: str) -> str:
    if not names:
        return body
    parts = [f"{n} AS ({VIEWS[n][1]})" for n in _ordered(names, [])]
    return "WITH " + ",\n".join(parts) + "\n" + body


def query(name: str, sql: str | None = None, uses: list[str] | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(uses or [], sql)
        return fn

    return register


def view(name: str, uses: list[str], body: str) -> None:
    VIEWS[name] = (uses, body)
