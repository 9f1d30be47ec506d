"""SQL text over registered views, with named arguments filled from the run parameters.

The text is fixed; values go in as typed arguments (``:name``), never by formatting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carelake.params import Params
from carelake.plans import marts

#: Billed and denied amounts per encounter type in the look-back window, over the views dim_encounter and fact_charges.
BILLED_BY_TYPE = """
SELECT encounter_type, count(*) AS charges, sum(billed_amt) AS billed,
       count_if(billed_amt > CAST(:high_cost AS DECIMAL(20, 2))) AS high_cost,
       count_if(claim_status = 'DENIED') AS denied
FROM dim_encounter JOIN fact_charges USING (encounter_id)
WHERE encounter_dttm >= :cutoff
GROUP BY encounter_type"""


def arguments(params: Params) -> dict:
    """Every named argument that a text may use."""
    return {"cutoff": marts.lookback_cutoff(params), "high_cost": params.high_cost_threshold,
            "as_of": params.as_of_date, "year": params.measurement_year}


def run_text(spark: SparkSession, text: str, params: Params, views: dict[str, DataFrame]) -> DataFrame:
    """Register ``views`` and run ``text`` with the arguments it names."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(text, args={k: v for k, v in arguments(params).items() if f":{k}" in text})
