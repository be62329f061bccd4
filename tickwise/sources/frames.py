"""Exchange frames: decode (S1), normalize (S2), closed filter (F1), symbol
index (F2), intrabar collapse (F5), subscription filter (J2), heartbeats
(S5) and message routing (S6).

Frames are JSON text, one per row, with the arrival order given by
(``recv_ms``, ``frame_no``).  Decoding goes through the VARIANT type:
``try_parse_json`` once per row, then one case-sensitive path lookup per
declared leaf, with its JSON type checked by ``schema_of_variant``.  A frame
is kept only when every declared leaf is present with the declared type
(unknown keys are ignored); anything else -- acknowledgements, junk, a
number where text is declared, a missing leaf -- goes to the rejects with a
reason.  All of it is row-local: no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import parse_price
from ..functions.time import label_utc8
from ..operators.series import next_value

# The exchange name given to decoded bars, and the heartbeat source.
FRAME_EXCHANGE = "binance"
PING_SOURCE = "binance"

# Declared leaves of a kline frame: (output column, JSON path, JSON type).
# "int64" / "int32" are whole numbers in those ranges.
FRAME_LEAVES = [
    ("stream", "$.stream", "string"),
    ("event_type", "$.data.e", "string"),
    ("event_time", "$.data.E", "int64"),
    ("symbol", "$.data.s", "string"),
    ("start_ms", "$.data.k.t", "int64"),
    ("end_ms", "$.data.k.T", "int64"),
    ("k_symbol", "$.data.k.s", "string"),
    ("interval", "$.data.k.i", "string"),
    ("open_text", "$.data.k.o", "string"),
    ("close_text", "$.data.k.c", "string"),
    ("high_text", "$.data.k.h", "string"),
    ("low_text", "$.data.k.l", "string"),
    ("volume_text", "$.data.k.v", "string"),
    ("trades", "$.data.k.n", "int32"),
    ("closed", "$.data.k.x", "bool"),
]
SPARK_TYPES = {"string": "string", "int64": "bigint", "int32": "bigint", "bool": "boolean"}
VARIANT_TYPE_NAMES = {"string": ["STRING"], "int64": ["BIGINT", "INT", "SMALLINT", "TINYINT"],
                      "int32": ["BIGINT", "INT", "SMALLINT", "TINYINT"], "bool": ["BOOLEAN"]}
INT32_MIN, INT32_MAX = -(2 ** 31), 2 ** 31 - 1

FRAME_COLUMNS = ["recv_ms", "frame_no"] + [c for c, _, _ in FRAME_LEAVES]


def decode_all(raw: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """raw (recv_ms, frame_no, text) -> every frame with its leaves, the columns
    in ``keep`` and a ``reject_reason`` (null for a good frame).

    Two projections: the JSON type of every leaf first (one variant lookup
    each), then values and the reason from those types.  Keeping them apart
    keeps each generated function small enough for whole-stage codegen.
    """
    # The parsed value comes out of a generator so that later filters on the
    # decoded leaves cannot be rewritten in terms of ``parse_json(text)``
    # (which would parse the text once per leaf instead of once per frame).
    base = ["recv_ms", "frame_no", *keep]
    v = raw.select(*base, F.explode(F.array(F.try_parse_json("text"))).alias("_v"))
    types = v.select(
        *base, "_v",
        *[F.schema_of_variant(F.try_variant_get(F.col("_v"), path, "variant")).alias(f"_t{i}")
          for i, (_, path, _) in enumerate(FRAME_LEAVES)],
    )
    reason: Column = F.when(F.col("_v").isNull(), F.lit("not_json"))
    cols = []
    for i, (name, path, kind) in enumerate(FRAME_LEAVES):
        typ = F.col(f"_t{i}")
        ok = typ.isin(*VARIANT_TYPE_NAMES[kind])
        value = F.try_variant_get(F.col("_v"), path, SPARK_TYPES[kind])
        if kind == "int32":
            value = F.when(value.between(INT32_MIN, INT32_MAX), value)
            ok = ok & value.isNotNull()
        reason = reason.when(typ.isNull() | (typ == F.lit("VOID")), F.lit(f"missing:{path[2:]}")).when(~ok, F.lit(f"type:{path[2:]}"))
        cols.append(F.when(ok, value).alias(name))
    return types.select(*base, *cols, reason.alias("reject_reason"))


def decode_frames(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(frames, rejects)."""
    allf = decode_all(raw)
    frames = allf.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    rejects = allf.filter(F.col("reject_reason").isNotNull()).select("recv_ms", "frame_no", "reject_reason")
    return frames, rejects


def closed_bars(frames: DataFrame) -> DataFrame:
    """only frames whose bar has closed."""
    return frames.filter(F.col("closed"))


def bar_fields(exchange: str = FRAME_EXCHANGE) -> dict[str, Column]:
    """The fields of a bar from a decoded frame (outer symbol, text prices parsed strictly or 0.0)."""
    prices = {n: parse_price(f"{n}_text") for n in ("open", "high", "low", "close", "volume")}
    return {
        "exchange": F.lit(exchange), "symbol": F.col("symbol"), "open_time_ms": F.col("start_ms"), "close_time_ms": F.col("end_ms"),
        "open_time_h": label_utc8("start_ms"), "interval": F.col("interval"), **prices, "trades_count": F.col("trades").cast("bigint"),
    }


def normalize_bars(frames: DataFrame, exchange: str = FRAME_EXCHANGE) -> DataFrame:
    """Frame -> bar."""
    return frames.select(*[c.alias(n) for n, c in bar_fields(exchange).items()])


def symbol_index(frames: DataFrame) -> DataFrame:
    """dense 1-based index per symbol in first-arrival order (all frames,
    open ones included; simultaneous arrivals by symbol name).  The ranking is
    one unpartitioned window over the per-symbol table: one row per symbol."""
    first = frames.groupBy("symbol").agg(F.min(F.struct("recv_ms", "frame_no", "symbol")).alias("_first"))
    w = Window.orderBy("_first")
    return first.select("symbol", F.row_number().over(w).cast("bigint").alias("symbol_index"))


def collapse_updates(frames: DataFrame, chunk_rows: int | None = None) -> DataFrame:
    """of each run of updates with the same start time (per symbol and
    interval, in arrival order) keep the last one, emitted when a different
    start time arrives -- so the last run of each series is withheld.
    (``chunk_rows`` is accepted for older callers; nothing is chunked any more.)"""
    s = next_value(frames, ["symbol", "interval"], ["recv_ms", "frame_no"], "start_ms", "_next_start")
    return s.filter(F.col("_next_start").isNotNull() & (F.col("_next_start") != F.col("start_ms"))).drop("_next_start")


def subscribed_bars(bars: DataFrame, subs: DataFrame) -> DataFrame:
    """Keep (symbol, interval) pairs of the subscription list (whether it
    is broadcast is left to its measured size)."""
    s = subs.select(F.lower("symbol").alias("_sub_symbol"), F.col("interval").alias("_sub_interval"))
    cond = (F.lower(bars["symbol"]) == s["_sub_symbol"]) & (bars["interval"] == s["_sub_interval"])
    return bars.join(s, cond, "left_semi")


# ---- frames from bars (the test feed) -----------------------------------------------------

def _num(c: str) -> Column:
    return F.col(c).cast("string")


FRAME_TEMPLATE = (
    '{"stream":"%s@kline_%s","data":{"e":"kline","E":%s,"s":"%s","k":{"t":%s,"T":%s,"s":"%s","i":"%s",'
    '"f":1,"L":2,"o":%s,"c":"%s","h":"%s","l":"%s","v":"%s"%s,"x":%s,"q":"0","V":"0","Q":"0","B":"0"}}}'
)


def frame_text(bars: DataFrame, closed: Column, open_text: Column | None = None, drop_trades: Column | None = None,
               high_text: Column | None = None) -> Column:
    o = open_text if open_text is not None else F.concat(F.lit('"'), _num("open"), F.lit('"'))
    h = high_text if high_text is not None else _num("high")
    n_part = F.concat(F.lit(',"n":'), F.col("trades_count").cast("string"))
    if drop_trades is not None:
        n_part = F.when(drop_trades, F.lit("")).otherwise(n_part)
    return F.format_string(
        FRAME_TEMPLATE, F.lower("symbol"), F.col("interval"), _num("close_time_ms"), F.col("symbol"),
        _num("open_time_ms"), _num("close_time_ms"), F.col("symbol"), F.col("interval"), o, _num("close"), h,
        _num("low"), _num("volume"), n_part, F.when(closed, F.lit("true")).otherwise(F.lit("false")),
    )


def frames_from_bars(bars: DataFrame) -> DataFrame:
    """A frame feed built from bars (the test feed): per bar one open update
    and one closed frame; some bars also yield a frame with a number where
    text is declared, a frame without ``n``, an acknowledgement, a junk
    line, or a price text no parser accepts -- chosen by the bar's trade
    count, so the feed grows with the data."""
    n = F.col("trades_count")
    closed = F.lit(True)
    high = F.when(n % 5 == 4, F.lit("abc")).otherwise(_num("high"))

    def frame(no: int, recv: Column, text: Column, when: Column | None = None) -> Column:
        made = F.struct(recv.alias("recv_ms"), F.lit(no).alias("frame_no"), text.alias("text"))
        return made if when is None else F.when(when, made)

    end = F.col("close_time_ms")
    made = F.array(
        frame(0, F.col("open_time_ms") + 1000, frame_text(bars, F.lit(False))),
        frame(1, end + 1, frame_text(bars, closed, high_text=high)),
        frame(2, end + 2, frame_text(bars, closed, open_text=_num("open")), n % 7 == 3),
        frame(3, end + 2, frame_text(bars, closed, drop_trades=F.lit(True)), n % 7 == 5),
        frame(4, end + 3, F.lit('{"result":null,"id":1}'), n % 11 == 0),
        frame(5, end + 3, F.lit("pong"), n % 13 == 1),
    )
    return bars.select(F.explode(made).alias("f")).where("f IS NOT NULL").select("f.*")


def frames_sql(bars_sql: str) -> str:
    """DuckDB: the same feed from a bars query."""
    def text(closed: str, o: str | None = None, drop_n: bool = False, h: str | None = None) -> str:
        o = o or "'\"' || CAST(open AS VARCHAR) || '\"'"
        h = h or "CAST(high AS VARCHAR)"
        n_part = "''" if drop_n else "',\"n\":' || CAST(trades_count AS VARCHAR)"
        return (
            "'{\"stream\":\"' || lower(symbol) || '@kline_' || interval || '\",\"data\":{\"e\":\"kline\",\"E\":' || CAST(close_time_ms AS VARCHAR) || "
            "',\"s\":\"' || symbol || '\",\"k\":{\"t\":' || CAST(open_time_ms AS VARCHAR) || ',\"T\":' || CAST(close_time_ms AS VARCHAR) || "
            "',\"s\":\"' || symbol || '\",\"i\":\"' || interval || '\",\"f\":1,\"L\":2,\"o\":' || " + o + " || "
            "',\"c\":\"' || CAST(close AS VARCHAR) || '\",\"h\":\"' || " + h + " || '\",\"l\":\"' || CAST(low AS VARCHAR) || "
            "'\",\"v\":\"' || CAST(volume AS VARCHAR) || '\"' || " + n_part + " || ',\"x\":" + closed + ",\"q\":\"0\",\"V\":\"0\",\"Q\":\"0\",\"B\":\"0\"}}}'"
        )
    return f"""
SELECT open_time_ms + 1000 AS recv_ms, 0 AS frame_no, {text('false')} AS text FROM ({bars_sql})
UNION ALL SELECT close_time_ms + 1, 1, {text('true', h="CASE WHEN trades_count % 5 = 4 THEN 'abc' ELSE CAST(high AS VARCHAR) END")} FROM ({bars_sql})
UNION ALL SELECT close_time_ms + 2, 2, {text('true', o='CAST(open AS VARCHAR)')} FROM ({bars_sql}) WHERE trades_count % 7 = 3
UNION ALL SELECT close_time_ms + 2, 3, {text('true', drop_n=True)} FROM ({bars_sql}) WHERE trades_count % 7 = 5
UNION ALL SELECT close_time_ms + 3, 4, '{{"result":null,"id":1}}' FROM ({bars_sql}) WHERE trades_count % 11 = 0
UNION ALL SELECT close_time_ms + 3, 5, 'pong' FROM ({bars_sql}) WHERE trades_count % 13 = 1"""


def decode_sql(frames_query: str) -> str:
    """DuckDB: decode with per-leaf JSON types; columns as ``decode_all``."""
    checks, values = [], []
    for name, path, kind in FRAME_LEAVES:
        t = f"json_type(text, '{path}')"
        if kind == "string":
            ok = f"{t} = 'VARCHAR'"
            val = f"json_extract_string(text, '{path}')"
        elif kind == "bool":
            ok = f"{t} = 'BOOLEAN'"
            val = f"CAST(json_extract(text, '{path}') AS BOOLEAN)"
        else:
            lo, hi = (INT32_MIN, INT32_MAX) if kind == "int32" else (-(2 ** 63), 2 ** 63 - 1)
            val = f"TRY_CAST(json_extract_string(text, '{path}') AS BIGINT)"
            ok = f"({t} IN ('UBIGINT', 'BIGINT') AND {val} BETWEEN {lo} AND {hi})"
        checks.append(f"WHEN {t} IS NULL OR {t} = 'NULL' THEN 'missing:{path[2:]}' WHEN NOT {ok} THEN 'type:{path[2:]}'")
        values.append(f"CASE WHEN {ok} THEN {val} END AS {name}")
    return f"""
SELECT recv_ms, frame_no, {', '.join(values)}, CASE {' '.join(checks)} END AS reject_reason
FROM ({frames_query}) q WHERE json_valid(text)
UNION ALL
SELECT recv_ms, frame_no, {', '.join('NULL' for _ in FRAME_LEAVES)}, 'not_json' FROM ({frames_query}) q WHERE NOT json_valid(text)"""


def heartbeat_events(messages: DataFrame) -> DataFrame:
    """One heartbeat per feed ping.  messages: kind, recv_ts_ms, ...; rows
    of kind ``ping`` with a time are heartbeats."""
    return messages.filter((F.col("kind") == "ping") & F.col("recv_ts_ms").isNotNull()).select(
        F.lit(PING_SOURCE).alias("source"), F.col("recv_ts_ms"), F.lit("").alias("remark"))


def route_messages(bars: DataFrame, heartbeats: DataFrame, rejects: DataFrame) -> DataFrame:
    """One message table; closed bars go to the strategy, heartbeats to
    the alerts, parse errors to the log."""
    b = bars.select(F.lit("strategy").alias("route"), F.lit("kline").alias("kind"), "symbol", F.col("close_time_ms").alias("ts_ms"),
                    F.lit(None).cast("string").alias("detail"))
    h = heartbeats.select(F.lit("alerts").alias("route"), F.lit("ping").alias("kind"), F.lit(None).cast("string").alias("symbol"),
                          F.col("recv_ts_ms").alias("ts_ms"), F.col("source").alias("detail"))
    e = rejects.select(F.lit("log").alias("route"), F.lit("error").alias("kind"), F.lit(None).cast("string").alias("symbol"),
                       F.col("recv_ms").alias("ts_ms"), F.concat(F.lit("Parse error: "), F.col("reject_reason")).alias("detail"))
    return b.unionByName(h).unionByName(e)


def subscription_table(spark, pairs: Iterable[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(list(pairs), "symbol string, interval string")
