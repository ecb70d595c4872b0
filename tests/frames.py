"""Helpers of the tests that are no fixtures."""


def column(df, name):
    return [r[name] for r in df.orderBy("ticker", "date").collect()]


def plan_of(df, run=False):
    if run:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
