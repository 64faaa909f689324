"""Fixed values that results depend on.

These are stated once, in natural order, and used everywhere else.
"""

# --- Fixed values: special token ids (pad, bos, eos, unk) -------------------
PAD_ID = 0
BOS_ID = 1
EOS_ID = 2
UNK_ID = 3
SPECIAL_PIECES = ["<pad>", "<s>", "</s>", "<unk>"]

# --- Fixed values: configuration defaults of the training setup -------------
VOCAB_SIZE = 16384
MAX_LEN = 1024
MAX_ROWS = 2007723
TRAIN_FRAC = 0.9
BATCH_SIZE = 16
LABEL_SMOOTHING = 0.15
EVAL_TEMPERATURE = 1.2
LENGTH_ALPHA = 0.6
NGRAM_SIZE = 3
REPETITION_PENALTY = 0.5
BLEU_WEIGHTS = (0.5, 0.5)
BLEU_EPSILON = 0.1
EARLY_STOP_PATIENCE = 2
TOP_CHECKPOINTS = 3
SAMPLE_EVERY = 50
SAMPLE_BEAM = 8
SAMPLE_DIVERSITY = 0.1
SAMPLE_MAX_LEN = 30
BEAM_SIZE = 5
MASK_VALUE = -1e9
MIN_TEMPERATURE = 1e-5
UNK_SURFACE = " ⁇ "
WORD_BOUNDARY = "▁"

# --- Fixed values: Unicode whitespace, as one regex class body ---------------
# Equal to Python's ``\s`` / ``str.strip`` set; written with escapes that both
# Java regex and RE2 (DuckDB) accept.
WS = (r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
      r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")

# --- Fixed values: strings pandas' CSV reader turns into missing values ------
NA_STRINGS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]
