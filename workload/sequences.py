"""Q1-Q3. (The sequence classifier Q4 is with the models.)"""

from pyspark.sql import functions as F

from lendscope.operators import sequences
from workload.evaluation import rounded
from workload.registry import query
from workload.views import view

ORDER, FEATURES = ("rpt_ts", "tie"), ("current_upb", "delinq")
LENGTH = 3
NUMBERED = "numbered AS (SELECT *, row_number() OVER (PARTITION BY loan_seq_num ORDER BY rpt_ts, tie) AS row_no FROM perf)"
BLOCKS = f"""{NUMBERED}, blocks AS (SELECT loan_seq_num, CAST(floor((row_no - 1) / 3) AS BIGINT) AS seq_no, count(*) AS n,
  max(CASE WHEN (row_no - 1) % 3 = 0 THEN current_upb END) AS upb_1, max(CASE WHEN (row_no - 1) % 3 = 1 THEN current_upb END) AS upb_2,
  max(CASE WHEN (row_no - 1) % 3 = 2 THEN current_upb END) AS upb_3, CAST(max(CASE WHEN (row_no - 1) % 3 = 2 THEN delinq END) AS DOUBLE) AS delinq_3
  FROM numbered GROUP BY 1, 2 HAVING count(*) = 3)"""


def blocks(spark, sf_dir):
    return sequences.block_sequences(view(spark, sf_dir, "perf"), "loan_seq_num", ORDER, FEATURES, LENGTH)


def _spread(df):
    return df.withColumns({
        "upb_1": F.col("steps")[0][0], "upb_2": F.col("steps")[1][0], "upb_3": F.col("steps")[2][0], "delinq_3": F.col("steps")[2][1],
    }).drop("steps")


@query("q01_block_sequences", f"WITH {BLOCKS} SELECT loan_seq_num, seq_no, upb_1, upb_2, upb_3, delinq_3 FROM blocks")
def q01(spark, sf_dir):
    return _spread(blocks(spark, sf_dir))


@query("q02_sliding_sequences", f"""
WITH {NUMBERED}, slid AS (SELECT loan_seq_num, row_no AS end_no, lag(current_upb, 2) OVER w AS upb_1, lag(current_upb, 1) OVER w AS upb_2,
  current_upb AS upb_3, CAST(delinq AS DOUBLE) AS delinq_3 FROM numbered WINDOW w AS (PARTITION BY loan_seq_num ORDER BY row_no))
SELECT * FROM slid WHERE end_no >= 3""")
def q02(spark, sf_dir):
    perf = view(spark, sf_dir, "perf")
    return _spread(sequences.sliding_sequences(perf, "loan_seq_num", ORDER, FEATURES, LENGTH))


@query("q03_sequence_labels", f"""
WITH {BLOCKS}, means AS (SELECT *, (upb_3 + delinq_3) / 2 AS last_mean FROM blocks)
SELECT loan_seq_num, seq_no, round(last_mean, 8) AS last_mean,
  CASE WHEN last_mean > (SELECT quantile_cont(last_mean, 0.9) FROM means) THEN 1 ELSE 0 END AS label FROM means""")
def q03(spark, sf_dir):
    return rounded(sequences.label_sequences(blocks(spark, sf_dir)).drop("steps"), 8, "last_mean")
