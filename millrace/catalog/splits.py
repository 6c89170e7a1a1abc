"""Parts and folds."""

from __future__ import annotations

from millrace.catalog.base import EVENT, bucket_sql, query, table
from millrace.operators.counts import count_by
from millrace.operators.split import with_fold, with_part


@query(
    "hash_split_counts",
    f"""
SELECT CASE WHEN {bucket_sql(["event_id"], 10)} < 9 THEN 'train' ELSE 'test' END AS part, count(*) AS n
FROM events GROUP BY 1
""",
)
def hash_split_counts(spark, sf_dir):
    return count_by(with_part(table(spark, sf_dir, "events"), EVENT), "part")


@query(
    "fold_sizes",
    f"""SELECT CAST({bucket_sql(["event_id"], 5)} AS INT) AS fold, count(*) AS n FROM events GROUP BY 1""",
)
def fold_sizes(spark, sf_dir):
    return count_by(with_fold(table(spark, sf_dir, "events"), EVENT, 5), "fold")
