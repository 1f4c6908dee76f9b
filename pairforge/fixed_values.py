"""Texts, word lists and lookup tables that results depend on.

Changing any of these changes ids, hashes or training rows, so they are kept
together here as plain text.
"""

# Characters stripped from both ends of questions, queries and replies.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Catalog column type -> SQL type; any other type is TEXT.
SQL_TYPES = {
    "text": "TEXT",
    "number": "NUMERIC",
    "time": "TIMESTAMP",
    "boolean": "BOOLEAN",
    "others": "TEXT",
}
DEFAULT_SQL_TYPE = "TEXT"

# Files a corpus release must contain.
WANTED_FILES = ["tables.json", "train_spider.json", "train_others.json", "dev.json"]

# Quality limits.
MAX_FAILURE_RATE = 0.02
MAX_FALLBACK_RATE = 0.05
MIN_EXAMPLES_PER_SPLIT = 100
MIN_TABLE_RECALL = 0.90
MIN_COLUMN_RECALL = 0.80
MAX_UNPARSEABLE_RATE = 0.01

# Sizes.
FAILURE_SAMPLE_SIZE = 50
INVALID_SAMPLE_SIZE = 10
EVAL_SAMPLE_SIZE = 50
MAX_SEQ_LEN = 1024
MAX_PREVIEW_ROWS = 20
MAX_PREVIEW_COLS = 12
PREVIEW_CELL_CHARS = 40
MAX_RETRIES = 2
HISTORY_TURNS = 8

# Chart types a presentation may use.
CHART_TYPES = ["bar", "line", "pie", "scatter", "area", "histogram"]

# Answer stored for a failed request, and the stream terminator.
FAILURE_ANSWER = "Sorry, I am potato."
STREAM_DONE = "[DONE]"
NO_SQL_ERROR = "no SQL was generated"

# Model aliases and artifact schemes.
CANDIDATE = "candidate"
CHAMPION = "champion"
PREV_CHAMPION = "prev-champion"
TRACKED_SCHEME = "mlflow-artifacts:/"
OBJECT_SCHEME = "s3://"
ARTIFACT_BUCKET = "mlflow"

# Prompt texts. They are hashed into prompt fingerprints and
# written into training rows, so every character counts.
PROMPT_VERSION = "v1"

PRUNER_SYSTEM = """You are a schema pruner for a text-to-SQL system. Given a database schema and a user question, select the minimal set of tables and columns needed to answer the question, including primary keys of the selected tables and the foreign keys that link them.
Answer with one line per table, exactly in the format:
table_name(column_1, column_2)
Output nothing else."""

PRUNER_USER = """Database schema:
{schema}

Question: {question}"""

GENERATOR_SYSTEM = """You are a text-to-SQL generator for a SQLite database. Given a database schema and a user question, write a single SQL query that answers the question.
Rules:
- Use only the tables and columns that appear in the provided schema.
- Target the SQLite dialect.
- Return exactly one SQL statement.
- Output only the SQL query: no explanation, no comments, no markdown fences."""

GENERATOR_USER = """Database schema:
{schema}

Question: {question}"""

GENERATOR_RETRY = """Database schema:
{schema}

Question: {question}

Your previous SQL query failed and must be corrected.
Previous SQL:
{prev_sql}

Database error:
{error}"""

PRESENTER_SYSTEM = """You turn a SQL query result into a short answer and an optional chart specification for a user's question. You are given the user's question and a preview of the result rows (column names plus a few rows).
Respond with exactly ONE JSON object and nothing else (no prose, no markdown fences), with these keys, in this order:
  "chart": either null, or an object describing how to plot the result:
      {"type": <chart type>, "x": <column>, "y": [<column>, ...], "series": <column or null>}
      type must be one of: bar, line, pie, scatter, area, histogram.
      x, y and series must be column names taken verbatim from the preview header.
  "answer": a 1-3 sentence plain-English answer to the question, grounded in the rows.
Decide the chart first, then write the answer.
Use null for chart when the result is not worth plotting: a single value, a single row, free text, or a bare list of identifiers/names. Prefer a chart when the result compares a numeric measure across categories or over time."""

PRESENTER_USER = """Question: {question}

Result preview ({n_rows} row(s)):
{preview}"""

PROMPTS = {
    "pruner": [PROMPT_VERSION, PRUNER_SYSTEM, PRUNER_USER],
    "generator": [PROMPT_VERSION, GENERATOR_SYSTEM, GENERATOR_USER, GENERATOR_RETRY],
    "presenter": [PROMPT_VERSION, PRESENTER_SYSTEM, PRESENTER_USER],
}
