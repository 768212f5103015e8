"""Values that fix the data formats. Changing one changes every result."""

# ---- fixed values -------------------------------------------------------------------
END_OF_TEXT = 50256
END_OF_TEXT_PIECE = "<|endoftext|>"
VOCAB_SIZE = 50304
BLOCK_SIZE = 2048
MAX_TOKEN_ID = 65535

PAD_TOKEN = 0
IGNORE_INDEX = -100

SEED = 42
CORPUS_VAL_FRACTION = 0.005
SINGLE_TURN_HEAD = 5_000
SINGLE_TURN_BLEND = 2_500
CHAT_CAP = 200_000
CHAT_HEAD = 20_000
CHAT_BLEND = 10_000
SFT_VAL_FRACTION = 0.02

# published GPT-2 pre-split pattern
PRESPLIT_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>"
DEFAULT_SYSTEM = "You are a helpful assistant."

INSTRUCTION_HEADER = "### Instruction:\n"
INPUT_HEADER = "\n\n### Input:\n"
RESPONSE_HEADER = "\n\n### Response:\n"

# source role -> rendered role
ROLES = {
    "system": "system",
    "human": "user",
    "user": "user",
    "gpt": "assistant",
    "assistant": "assistant",
}

BATCH_SIZE = 4
ACCUMULATION_STEPS = 32
PRETRAIN_STEPS = 60_000
SFT_STEPS = 4_000
SAVE_EVERY = 500
EVALUATE_EVERY = 5_000

# loss = E + A / N^alpha + B / D^beta
SCALING_E = 1.69
SCALING_A = 406.4
SCALING_ALPHA = 0.34
SCALING_B = 410.7
SCALING_BETA = 0.28
SCALING_PARAMETERS = 350e6

RESULT_METRICS = ("hellaswag", "lambada", "arc_easy", "arc_challenge", "winogrande", "val_loss")
MISSING_TEXT = "TBD"
# ---- end of fixed values ------------------------------------------------------------

TOKENS_PER_STEP = BATCH_SIZE * ACCUMULATION_STEPS * BLOCK_SIZE
EXAMPLES_PER_STEP = BATCH_SIZE * ACCUMULATION_STEPS

# metric name -> pattern of its line in an evaluation log, as ``formats`` writes it (matched without regard to case)
LOG_PATTERNS = {
    name: name.replace("_", " ") + r"\s+(\d+\.\d+)" + ("" if name.endswith("loss") else "%") for name in RESULT_METRICS
}
