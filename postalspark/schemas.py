"""Schemas and fixed values shared by every module.

Codes are always strings: a leading zero is part of the code.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the behaviour being reproduced)
# ---------------------------------------------------------------------------

# Fields of a lookup response / stored address, in export order.
ADDRESS_FIELDS = ["cep", "logradouro", "complemento", "bairro", "localidade",
                  "uf", "ibge", "gia", "ddd", "siafi"]
# Export order adds the two timestamps.
EXPORT_FIELDS = ADDRESS_FIELDS + ["created_at", "updated_at"]
# Columns of the Parquet result set of the batch job (city column as localidade).
PARQUET_FIELDS = ["cep", "logradouro", "complemento", "bairro", "localidade", "uf", "ibge", "ddd"]
# Keys a lookup response must carry to count as usable.
REQUIRED_RESPONSE_KEYS = ["cep", "localidade", "uf"]
# Error log header, in file order.
ERROR_LOG_FIELDS = ["cep", "error_type", "error_message", "timestamp", "context"]
# Error types; network_error and unknown_error are declared but never produced.
ERROR_TYPES = ["api_timeout", "api_error", "cep_not_found", "database_error",
               "validation_error", "network_error", "unknown_error"]
# Phrases that mark a connection-level failure (longer retry waits).
CONNECTION_ERROR_PHRASES = ["connection refused", "connection aborted", "connection reset",
                            "remote end closed", "failed to establish"]
# Path parts that disqualify a crawl link.
SKIPPED_LINK_PARTS = ["/blog/", "/sobre/", "/contato/", "/meu-cep/"]
# Default crawl start page, collection target and regional code prefix.
DEFAULT_BASE_URL = "https://codigo-postal.org/pt-br/brasil/sp/sao-paulo/"
DEFAULT_MAX_CODES = 10000
REGIONAL_PREFIX = "0"
# Lookup service address and the texts logged for failed lookups ({cep} is the code).
DEFAULT_SERVICE_URL = "https://viacep.com.br/ws"
MSG_NOT_FOUND = "CEP {cep} not found in ViaCEP"
MSG_NOT_OBJECT = "Invalid response format for CEP {cep}"
MSG_MALFORMED = "Invalid JSON in response for CEP {cep}"
MSG_HTTP_404 = "404 Client Error: Not Found for url: {url}/{cep}/json/"
# Lookup retries, base retry delay (s), consumer rate (msg/s) and streak length.
RETRY_ATTEMPTS = 3
RETRY_DELAY = 1.0
RATE_LIMIT_PER_SECOND = 1.0
MAX_CONSECUTIVE_ERRORS = 3
MAX_BACKOFF_MULTIPLIER = 10.0
FAILURE_PAUSE_FACTOR = 1.5
# Whitespace removed by a Python-style strip(): the characters str.isspace() accepts.
PY_WHITESPACE_CLASS = (r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
                       r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")

# ---------------------------------------------------------------------------
# Struct types
# ---------------------------------------------------------------------------

CODES_CSV = T.StructType([T.StructField("cep", T.StringType(), True)])

RESPONSE = T.StructType([T.StructField(f, T.StringType(), True) for f in ADDRESS_FIELDS])

ADDRESS = T.StructType(
    [T.StructField("cep", T.StringType(), False)]
    + [T.StructField(f, T.StringType(), True) for f in ADDRESS_FIELDS[1:]]
    + [T.StructField("created_at", T.TimestampNTZType(), False),
       T.StructField("updated_at", T.TimestampNTZType(), False)]
)

ERROR_LOG = T.StructType([T.StructField(f, T.StringType(), True) for f in ERROR_LOG_FIELDS])

MESSAGE = T.StructType([T.StructField("cep", T.StringType(), True)])

ENVELOPE = T.StructType([
    T.StructField("Records", T.ArrayType(T.StructType([
        T.StructField("eventSource", T.StringType(), True),
        T.StructField("body", T.StringType(), True),
    ])), True),
])

# DDL of the address table (lengths as declared by the original model).
ADDRESS_DDL = (
    "cep VARCHAR(8) NOT NULL, logradouro VARCHAR(255), complemento VARCHAR(255), "
    "bairro VARCHAR(255), localidade VARCHAR(255), ibge VARCHAR(10), gia VARCHAR(10), "
    "ddd VARCHAR(2), siafi VARCHAR(10), created_at TIMESTAMP_NTZ NOT NULL, "
    "updated_at TIMESTAMP_NTZ NOT NULL, uf VARCHAR(2)"
)
