"""Option tables as text, one text per report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barframe.fixed_values import TABLE_ROWS, TABLE_RULE
from barframe.functions.text import (
    Rules,
    change_columns,
    option_symbol,
    period_label,
    render_cell,
    value_text,
)
from barframe.operators.rows import head_rows


def row_text(df: DataFrame, rules: Rules | None = None, atm_strike: float = 0) -> Column:
    """Strike and open interest, short symbol, and the changes that are not NULL."""
    types = dict(df.dtypes)

    def shown(name: str) -> Column:
        if name not in types:
            return F.lit("N/A")
        return F.coalesce(value_text(name, types[name]), F.lit("None"))

    strike = render_cell("Strike", "Strike", types["Strike"], rules, atm_strike) if "Strike" in types else F.lit("N/A")
    symbol = F.coalesce(option_symbol("Symbol"), F.lit("None")) if "Symbol" in types else F.lit("N/A")
    changes = [
        F.when(
            F.col(c).isNotNull(),
            F.concat(F.lit(f"{period_label(c)}: "), render_cell(c, c, types[c], rules, atm_strike)),
        )
        for c in change_columns(df.columns)
    ]
    joined = F.concat_ws(" | ", *changes)
    # concat_ws skips NULL, so a row without changes has no third line.
    line = F.when(joined != "", F.concat(F.lit("   "), joined))
    return F.concat_ws(
        "\n", F.concat(strike, F.lit(" | OI: "), shown("Latest_OI")), F.concat(F.lit("   "), symbol), line
    )


def render_table(
    df: DataFrame, title: str | Column = "", rules: Rules | None = None, max_rows: int = TABLE_ROWS,
    atm_strike: float = 0, key: str = "report_id", order: Sequence[str] = ("ord",),
) -> DataFrame:
    """``(key, text)``: the first ``max_rows`` rows of each report, by ``order``, in one block.

    Only those rows of a report are gathered. A report without rows has no text.
    """
    first = head_rows(df, list(order), max_rows, [key])
    lines = first.select(key, F.struct(*order, row_text(df, rules, atm_strike).alias("line")).alias("__row"))
    body = F.array_join(F.transform(F.sort_array(F.collect_list("__row")), lambda r: r["line"]), f"\n{TABLE_RULE}\n")
    name = F.lit(title) if isinstance(title, str) else title
    head = F.when(name != "", F.concat(F.lit("<b>📊 "), name, F.lit("</b>\n\n"))).otherwise("")
    text = F.concat(head, F.lit("<code>\n"), F.col("__body"), F.lit("\n</code>"))
    return lines.groupBy(key).agg(body.alias("__body")).select(key, text.alias("text"))
