"""What several test modules use."""

SMALL = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    """The physical plan with nothing cut off."""
    explain = df.sparkSession._jvm.PythonSQLUtils.explainString
    return explain(df._jdf.queryExecution(), "formatted")
