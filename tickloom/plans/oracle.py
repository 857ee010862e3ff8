"""DuckDB SQL twins of the fixture views, composed into ``WITH`` prefixes.

Each oracle query names the fixture views it needs; ``with_views`` emits them
(and their dependencies) in dependency order ahead of the query body.
"""

from __future__ import annotations

from ..sources.fixtures import DAYS, FADE, FIRST_DAY, GRID_LONG, GRID_SHORT, ORGANISATIONS, PERIODS, REPEATED, SEGMENTS, SIGNAL_MODELS

_SEG_LIST = ", ".join(f"'{s}'" for s in SEGMENTS)
_MODELS = ", ".join(f"('{m}', {k})" for m, k in SIGNAL_MODELS)
_PERIODS = ", ".join(f"('{n}', DATE '{s}', DATE '{e}')" for n, s, e in PERIODS)
_PARAMS = ", ".join(f"({s}, {lg})" for s in GRID_SHORT for lg in GRID_LONG if s < lg)

_ORGS = ", ".join(f"('{s}', '{o}')" for s, o in ORGANISATIONS)
_NEWS_COLS = """
               CASE WHEN event_id % 50 = 0 THEN 'x,'
                    ELSE concat_ws(',', CAST(value / 10 - 5 AS VARCHAR), CAST(value / 20 AS VARCHAR),
                                   CAST(value / 30 AS VARCHAR), CAST(value / 15 AS VARCHAR),
                                   CAST(user_id % 7 AS VARCHAR)) END AS v2tone,
               'Org ' || CAST(user_id % 5 AS VARCHAR) AS orgs,
               CASE WHEN event_id % 10 = 0 THEN 'srclc:xx' END AS translationinfo
        FROM """

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "bars": ((), """
        SELECT c.c_mktsegment AS symbol, CAST(o.o_orderdate AS DATE) AS date,
               arg_min(o.o_totalprice, o.o_orderkey) AS open, max(o.o_totalprice) AS high,
               min(o.o_totalprice) AS low, arg_max(o.o_totalprice, o.o_orderkey) AS close,
               count(*) AS volume
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
        GROUP BY 1, 2"""),
    "bars_rn": (("bars",), """
        SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) AS rn FROM bars"""),
    "px": (("bars",), """
        SELECT symbol, date, px, rn FROM (
          SELECT symbol, date,
                 avg(close) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS px,
                 row_number() OVER (PARTITION BY symbol ORDER BY date) AS rn
          FROM bars) WHERE rn > 50"""),
    "vix": ((), """
        SELECT d.date, round(10.0 + 40.0 * (d.m - (SELECT min(m) FROM (SELECT avg(o_totalprice) AS m FROM orders GROUP BY CAST(o_orderdate AS DATE))))
                       / ((SELECT max(m) FROM (SELECT avg(o_totalprice) AS m FROM orders GROUP BY CAST(o_orderdate AS DATE)))
                          - (SELECT min(m) FROM (SELECT avg(o_totalprice) AS m FROM orders GROUP BY CAST(o_orderdate AS DATE)))), 4) AS close
        FROM (SELECT CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) AS m FROM orders GROUP BY 1) d"""),
    "news": ((), "SELECT CAST(ts AS DATE) AS date," + _NEWS_COLS + "events"),
    "company_news": ((), f"SELECT DATE '{FIRST_DAY}' + CAST((event_id * {REPEATED} + k) % {DAYS} AS INTEGER) AS date,"
                     + _NEWS_COLS + f"(SELECT event_id, user_id, k, value * (1 + (k + 1) * CAST({FADE!r} AS DOUBLE)) AS value"
                     f" FROM events CROSS JOIN range({REPEATED}) r(k))"),
    "organisations": ((), f"SELECT * FROM (VALUES {_ORGS}) t(symbol, org)"),
    "posts": ((), f"""
        SELECT d.doc_id AS id,
               CASE WHEN d.doc_id % 97 = 0 THEN 'not a timestamp'
                    ELSE strftime(DATE '1996-01-01' + CAST(floor(d.doc_id / 25) AS INTEGER), '%Y-%m-%d') || ' '
                         || lpad(CAST(d.doc_id % 24 AS VARCHAR), 2, '0') || ':'
                         || lpad(CAST(d.doc_id % 60 AS VARCHAR), 2, '0') || ':00' END AS ts_text,
               ([{_SEG_LIST}])[CAST(d.doc_id % 5 + 1 AS INTEGER)] AS symbol,
               d.text,
               CASE WHEN l.quality = 1 THEN 'positive' WHEN l.quality = 0 THEN 'negative' ELSE 'neutral' END AS label,
               0.5 + (d.doc_id % 50) / 100 AS score,
               CAST(CASE WHEN d.doc_id % 17 = 0 THEN NULL ELSE d.doc_id % 13 END AS BIGINT) AS retweets,
               CAST(d.doc_id % 29 AS BIGINT) AS favoritos, d.lang
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""),
    "preds": (("px",), f"""
        SELECT model, symbol, date, price_close, confidence, predicted_signal,
               CAST(coalesce(lead(price_close) OVER (PARTITION BY model, symbol ORDER BY date) > price_close, false) AS INTEGER) AS label
        FROM (SELECT m.model, p.symbol, p.date, p.px AS price_close,
                     ((p.rn * m.k + length(p.symbol)) % 101) / 101.0 AS confidence,
                     CAST(((p.rn * m.k + length(p.symbol)) % 101) / 101.0 > 0.5 AS INTEGER) AS predicted_signal
              FROM px p CROSS JOIN (VALUES {_MODELS}) m(model, k))"""),
    "batches": (("bars_rn",), """
        SELECT symbol, date, open, high, low, close, volume, 1 AS batch_seq FROM bars_rn WHERE rn % 3 <> 0
        UNION ALL
        SELECT symbol, date, open, high, low, CASE WHEN rn % 7 = 0 THEN close + 1 ELSE close END AS close,
               volume, 2 AS batch_seq FROM bars_rn WHERE rn % 3 <> 1"""),
    "periods": ((), f"SELECT * FROM (VALUES {_PERIODS}) t(period, start, \"end\")"),
    "params": ((), f"SELECT * FROM (VALUES {_PARAMS}) t(short, long)"),
}


def _order(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        if n in out:
            return
        for d in VIEWS[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(views, body: str, ctes: list[tuple[str, str]] | None = None,
               recursive: bool = False) -> str:
    """``WITH <fixture views>, <extra ctes> <body>``."""
    parts = [f"{n} AS ({VIEWS[n][1]})" for n in _order(views)]
    parts += [f"{n} AS ({q})" for n, q in (ctes or [])]
    if not parts:
        return body
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n" + body


def dbl(x: float) -> str:
    """A double literal DuckDB will not turn into a DECIMAL."""
    return f"CAST({x!r} AS DOUBLE)"


def win(part: str = "symbol", order: str = "date", frame: str | None = None) -> str:
    """Window clause body: ``PARTITION BY .. ORDER BY .. [frame]``."""
    s = f"PARTITION BY {part} ORDER BY {order}"
    return f"{s} {frame}" if frame else s


def rows(n: int) -> str:
    return f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW"


def rolling_sql(agg: str, x: str, n: int, need: int | None = None, part: str = "symbol") -> str:
    """SQL twin of ``functions.exprs.rolling``."""
    w = win(part, "date", rows(n))
    return f"CASE WHEN count({x}) OVER ({w}) >= {need or n} THEN {agg}({x}) OVER ({w}) END"
