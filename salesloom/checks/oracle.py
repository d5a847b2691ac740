"""All SQL checks by query name."""

from __future__ import annotations

from salesloom.checks import catalog_sql, dirty_sql, insight_sql, measure_sql, model_sql, sink_sql, summary_sql

# Dashboard visuals that show another report's rows.
SAME_AS = {
    "v10d_repeat_rate": "i05_repeat_rate", "v10f_top_products_by_profit": "q03_top_products",
    "v16_return_reasons": "k09_return_reasons",
}

SQL: dict[str, str] = {**catalog_sql.SQL, **summary_sql.SQL, **measure_sql.SQL, **insight_sql.SQL, **model_sql.SQL, **sink_sql.SQL, **dirty_sql.SQL}
SQL.update({name: SQL[other] for name, other in SAME_AS.items()})
