"""Registry of named queries: ``QUERIES[name](spark, sf_dir) -> DataFrame`` and
the DuckDB oracle SQL for the same name (omitted for non-SQL operators)."""

from __future__ import annotations

import importlib

MODULES = ("corpus", "ie", "derive", "chat", "scoring", "tokenize", "logs", "streams", "files")


def _collect(attr: str) -> dict:
    out: dict = {}
    for m in MODULES:
        mod = importlib.import_module(f"quarry.plans.{m}")
        for k, v in getattr(mod, attr, {}).items():
            if k in out:
                raise KeyError(f"duplicate query name {k}")
            out[k] = v
    return out


# Outputs that are sums/averages of doubles depend on summation order, so two
# engines may differ in the last bit; the registered queries round them to 6
# decimals (the operators themselves return raw doubles).
ROUNDED = {
    "tier_report": ["mean_match_ratio"],
    "by_model": ["total_time_s", "avg_latency_s"],
    "structural_quality": ["avg_field_overlap"],
    "eval_totals": ["total_time_s", "avg_latency_s"],
    "round_wide": ["total_time_s", "avg_latency_s"],
    "bench_summary": ["time_mean", "tps_mean", "completion_tokens_avg", "ttft_mean"],
    "concurrency_summary": ["batch_mean", "tps_mean"],
    "speedup_summary": ["no_cache_time_s", "cache_time_s", "cache_prefill_time_s", "cache_decode_time_s", "no_cache_tps", "cache_decode_tps", "speedup"],
    "speedup_range": ["min_speedup", "mean_speedup", "max_speedup"],
    "loss_weighted": ["weighted_loss"],
    "baseline_compare": ["value", "baseline", "delta"],
    "stream_train_summary": ["weighted_loss"],
    "bench_csv": ["time_mean_s", "time_min_s", "time_max_s", "tok_s_mean", "tok_s_min", "tok_s_max", "ttft_mean_s"],
    "stability_csv": ["avg_latency_s"],
}


def _rounded(fn, cols):
    def run(spark, sf_dir):
        from pyspark.sql import functions as F

        df = fn(spark, sf_dir)
        # floor(x * 1e6 + 0.5001) / 1e6: plain IEEE double steps, identical in any
        # engine; exact ties, which sums in another order may miss by a last
        # bit on either side, lie clear of the step
        def r6(c):
            x = F.col(c)
            return F.when(F.isnan(x), x).otherwise(F.floor(x * F.lit(1e6) + F.lit(0.5001)).cast("double") / F.lit(1e6)).alias(c)

        return df.select(*[r6(c) if c in cols else F.col(c) for c in df.columns])

    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def _shipped(fn):
    def run(spark, sf_dir):
        from quarry.session import ship_package

        ship_package(spark)  # executors need the package for the Arrow UDFs
        return fn(spark, sf_dir)

    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict:
    q = _collect("QUERIES")
    return {k: _shipped(_rounded(v, ROUNDED[k]) if k in ROUNDED else v) for k, v in q.items()}


def oracle_sql() -> dict:
    o = _collect("ORACLE")
    out = {}
    for k, sql in o.items():
        if k in ROUNDED:
            cols = ROUNDED[k]
            sel = ", ".join(f"CASE WHEN isnan(\"{c}\") THEN \"{c}\" ELSE CAST(floor(\"{c}\" * 1e6::DOUBLE + 0.5001::DOUBLE) AS DOUBLE) / 1e6::DOUBLE END AS \"{c}\"" for c in cols)
            sql = f"SELECT * REPLACE ({sel}) FROM ({sql}) AS q"
        out[k] = sql
    return out
