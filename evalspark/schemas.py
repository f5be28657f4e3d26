"""Table schemas as DDL strings (accepted by every Spark reader)."""

INSTRUCTIONS = "instruction STRING, input STRING, output STRING"

PREDICTIONS = (
    "id BIGINT, checkpoint STRING, instruction STRING, input STRING, "
    "task_type STRING, prediction STRING, reference STRING"
)

PAIR_JUDGEMENTS = (
    "prompt_id STRING, checkpoint_a STRING, checkpoint_b STRING, "
    "response_a_scores MAP<STRING,DOUBLE>, response_b_scores MAP<STRING,DOUBLE>, "
    "winner STRING, justification STRING, swapped BOOLEAN"
)

# One row per call made for a prompt: status is ok, api_error or error.
ATTEMPT_LOG = "idx BIGINT, attempt INT, status STRING, text STRING"
