import pytest

from loanseason.schema import panel_schema
from loanseason.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "loanseason-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def panel_rows(spark):
    """Build a panel from a few given fields per row; everything else is NULL."""
    fields = panel_schema().fields
    order = [f.name for f in fields]

    def build(rows, vintage="2018Q1"):
        data = []
        for row in rows:
            base = {"LOAN_ID": "1", "ORIG_DATE": "012018", "DLQ_STATUS": "00"}
            base.update(row)
            data.append(tuple(base.get(c) for c in order) + (base.get("vintage", vintage),))
        from pyspark.sql import types as T

        schema = T.StructType(fields + [T.StructField("vintage", T.StringType())])
        return spark.createDataFrame(data, schema)

    return build


def period(age, start=2018 * 12 + 1):
    index = start + age - 1
    return f"{index % 12 + 1:02d}{index // 12}"


def month(age, loan="1", **extra):
    return {"LOAN_ID": loan, "ACT_PERIOD": period(age), "LOAN_AGE": age, **extra}
