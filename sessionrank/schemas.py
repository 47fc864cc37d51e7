"""Table schemas shared by the stages, and the default parameters."""

from pyspark.sql import types as T


def _table(**columns):
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


_LONG, _INT, _DOUBLE, _STRING = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()

RATINGS = _table(user_id=_LONG, item_id=_LONG, rating=_DOUBLE, timestamp=_LONG)
MOVIES = _table(item_id=_LONG, title=_STRING, genres=_STRING)
USERS = _table(user_id=_LONG, gender=_STRING, age=_INT, occupation=_INT, zip_code=_STRING)
RECS = _table(session_id=_LONG, item_id=_LONG, rank=_INT)
EVALUATION = _table(system=_STRING, metric=_STRING, value=_DOUBLE)
SLICES = _table(
    slice_type=_STRING, slice_value=_STRING, n_sessions=_LONG,
    metric=_STRING, value=_DOUBLE, system=_STRING,
)
COVERAGE = _table(
    catalog_size=_LONG, items_recommended=_LONG, coverage=_DOUBLE, system=_STRING
)
ERROR_REPORT = _table(
    session_id=_LONG, target_item_id=_LONG, target_rank=_INT, session_length=_LONG,
    item_train_count=_LONG, item_is_head=_INT, hit_at_k=T.BooleanType(),
)
IMPORTANCE = _table(feature=_STRING, importance=_DOUBLE)

SESSION_COLUMNS = ["user_id", "session_id", "item_id", "timestamp", "position"]

# The published defaults of the pipeline.
GAP_SECONDS = 1800
MIN_LENGTH = 2
MAX_LENGTH = 50
TEST_FRACTION = 0.2
VAL_FRACTION = 0.1
SEED = 42
RETRIEVAL_K = 100
RANKING_K = 10
K_VALUES = (5, 10, 20)
WINDOW = 5
HEAD_QUANTILE = 0.8
SPARSE_QUANTILE = 0.4
DENSE_QUANTILE = 0.6
ALS_FACTORS = 64
ALS_ITERATIONS = 20
ALS_REGULARIZATION = 0.01
