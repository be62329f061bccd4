"""Readable and JSON text of bars and trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbers import debug_number, display_number, sql_debug_number, sql_display_number

# Labels of the readable trade text.
DIRECTION_LABELS = {"Long": "开多", "Short": "开空", "LongClose": "平多", "ShortClose": "平空", "None": "未知错误"}
REASON_LABELS = {"StopProfit": "止盈", "StopLoss": "止损", "TrailingStop": "动态止盈止损", "None": "未知错误"}
ROI_REASON_FORMAT = ("投资回报率: ", "分钟收益", "%")
POSITION_FORMAT = ("持仓价格: ", ", 持仓大小: ", ", 入场K线位置: ")
TRADE_FORMAT = ("交易所:", ", 交易标的: ", ", 方向: ", ", 入场持仓: ", ", 出场持仓: ", ", 入场时间: ", ", 退场时间: ",
                ", 退出原因: ", ", 回报率(百分比): ")

BAR_FIELDS = ["exchange", "symbol", "open_time_ms", "close_time_ms", "open_time_h", "interval", "open", "high", "low",
              "close", "volume", "trades_count"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _label(col: Column, labels: dict[str, str], default: str) -> Column:
    out = None
    for k, v in labels.items():
        out = F.when(col == k, F.lit(v)) if out is None else out.when(col == k, F.lit(v))
    return out.otherwise(F.lit(default))


def position_text(price, size=None, index=None) -> Column:
    p = _c(price)
    size = F.lit(1.0) if size is None else size
    index = F.lit(0) if index is None else index
    body = F.concat(F.lit(POSITION_FORMAT[0]), display_number(p), F.lit(POSITION_FORMAT[1]), display_number(_c(size)),
                    F.lit(POSITION_FORMAT[2]), _c(index).cast("string"))
    return F.when(p.isNull(), F.lit("None")).otherwise(F.concat(F.lit("Some("), body, F.lit(")")))


def reason_text(reason, roi_minutes, roi_pct) -> Column:
    r = F.coalesce(_c(reason), F.lit("None"))
    roi = F.concat(F.lit(ROI_REASON_FORMAT[0]), _c(roi_minutes).cast("string"), F.lit(ROI_REASON_FORMAT[1]),
                   display_number(_c(roi_pct) * 100.0), F.lit(ROI_REASON_FORMAT[2]))
    return F.when(r == "Roi", roi).otherwise(_label(r, REASON_LABELS, REASON_LABELS["None"]))


def trade_text(t: DataFrame | None = None) -> Column:
    """C5 over ledger columns (positions have size 1 and bar index 0)."""
    roi = F.when(F.col("roi").isNull(), F.lit("None")).otherwise(F.concat(F.lit("Some("), debug_number("roi"), F.lit(")")))
    parts = [
        F.col("exchange"), F.col("symbol"), _label(F.coalesce("direction", F.lit("None")), DIRECTION_LABELS, DIRECTION_LABELS["None"]),
        position_text("enter_price"), position_text("exit_price"), F.col("enter_time").cast("string"),
        F.col("exit_time").cast("string"), reason_text("exit_reason", "roi_minutes", "roi_pct"), roi,
    ]
    pieces = []
    for label, part in zip(TRADE_FORMAT, parts):
        pieces += [F.lit(label), part]
    return F.concat(*pieces)


def sql_trade_text() -> str:
    def label(col: str, labels: dict[str, str], default: str) -> str:
        whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in labels.items())
        return f"(CASE coalesce({col}, 'None') {whens} ELSE '{default}' END)"

    def pos(price: str) -> str:
        return (f"(CASE WHEN {price} IS NULL THEN 'None' ELSE 'Some({POSITION_FORMAT[0]}' || {sql_display_number(price)} || "
                f"'{POSITION_FORMAT[1]}1{POSITION_FORMAT[2]}0)' END)")

    reason = (f"(CASE WHEN exit_reason = 'Roi' THEN '{ROI_REASON_FORMAT[0]}' || CAST(roi_minutes AS VARCHAR) || '{ROI_REASON_FORMAT[1]}' || "
              f"{sql_display_number('(roi_pct * 100.0)')} || '{ROI_REASON_FORMAT[2]}' ELSE {label('exit_reason', REASON_LABELS, REASON_LABELS['None'])} END)")
    roi = f"(CASE WHEN roi IS NULL THEN 'None' ELSE 'Some(' || {sql_debug_number('roi')} || ')' END)"
    parts = ["exchange", "symbol", label("direction", DIRECTION_LABELS, DIRECTION_LABELS["None"]), pos("enter_price"),
             pos("exit_price"), "CAST(enter_time AS VARCHAR)", "CAST(exit_time AS VARCHAR)", reason, roi]
    return " || ".join(f"'{lab}' || {p}" for lab, p in zip(TRADE_FORMAT, parts))


def json_number(c: Column) -> Column:
    """A double that JSON can hold: what is not finite becomes null."""
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(None)).otherwise(c)


def encode_bars(bars: DataFrame) -> Column:
    """One JSON object per bar, every field in declaration order; absent and non-finite numbers are ``null``."""
    kinds = dict(bars.dtypes)
    fields = [(json_number(F.col(c)) if kinds.get(c) == "double" else F.col(c)).alias(c) for c in BAR_FIELDS]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def encode_trades() -> Column:
    """C9 for ledger rows: enum fields in their serialized forms (unit variant
    -> string, ``Roi`` -> ``{"Roi":[minutes,pct]}``), optional positions as
    objects or null."""
    def position(price: str) -> Column:
        obj = F.to_json(F.struct(F.col(price).alias("price"), F.lit(0).alias("entry_bar_index"), F.lit(1.0).alias("size")))
        return F.when(json_number(F.col(price)).isNull(), F.lit("null")).otherwise(obj)

    reason = F.when(
        F.col("exit_reason") == "Roi",
        F.concat(F.lit('{"Roi":['), F.col("roi_minutes").cast("string"), F.lit(","), F.col("roi_pct").cast("string"), F.lit("]}")),
    ).otherwise(F.concat(F.lit('"'), F.coalesce("exit_reason", F.lit("None")), F.lit('"')))
    head = F.to_json(F.struct("exchange", "symbol", F.coalesce("direction", F.lit("None")).alias("direction")), {"ignoreNullFields": "false"})
    return F.concat(
        F.regexp_replace(head, "}$", ""),
        F.lit(',"enter_position":'), position("enter_price"),
        F.lit(',"exit_position":'), position("exit_price"),
        F.lit(',"enter_time":'), F.col("enter_time").cast("string"),
        F.lit(',"exit_time":'), F.col("exit_time").cast("string"),
        F.lit(',"exit_reason":'), reason,
        F.lit(',"roi":'), F.coalesce(json_number(F.col("roi")).cast("string"), F.lit("null")),
        F.lit(',"fee":'), F.col("fee").cast("string"), F.lit("}"),
    )
