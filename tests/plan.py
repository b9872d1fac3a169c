"""Physical plans as text."""


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df) -> str:
    """The plan after a run, with adaptive execution's final choices."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    return execution.executedPlan().toString()
