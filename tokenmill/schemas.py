"""Declared schemas of all inputs: nothing is inferred from data."""

from tokenmill.constants import RESULT_METRICS

DOCUMENTS = "doc_id BIGINT, text STRING"
TURNS = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
CONVERSATIONS = "conv_id BIGINT, conversations ARRAY<STRUCT<`from`: STRING, value: STRING>>"
INSTRUCTIONS = "pair_id STRING, instruction STRING, input STRING, output STRING"
SFT = "tokens ARRAY<INT>, loss_mask ARRAY<INT>"
SFT_FILE = "example_id STRING, source STRING, start BIGINT, tokens ARRAY<INT>, loss_mask ARRAY<INT>"
CHOICE_ITEMS = "item_id BIGINT, ctx STRING, endings ARRAY<STRING>, label INT"
LABELLED_ITEMS = (
    "item_id BIGINT, question STRING, "
    "choices STRUCT<text: ARRAY<STRING>, label: ARRAY<STRING>>, answer_key STRING"
)
LAST_WORD_ITEMS = "item_id BIGINT, text STRING"
CLOZE_ITEMS = "item_id BIGINT, sentence STRING, option1 STRING, option2 STRING, answer STRING"
METRIC_LOG = "run BIGINT, step BIGINT, metric STRING, value DOUBLE, logged_at TIMESTAMP_NTZ"
EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
RESULTS = ", ".join(f"{name} DOUBLE" for name in RESULT_METRICS)
PACKED_PARTS = "split STRING, path STRING, first_block BIGINT, records BIGINT, record_tokens INT, first_token BIGINT"
