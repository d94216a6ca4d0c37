from keelson.functions.columns import (
    bucket_of,
    code_label,
    file_path,
    plain_path,
    record_hash,
    set_digest,
    surrogate_key,
)
from keelson.functions.rules import all_pass, failed_rules

__all__ = [
    "all_pass",
    "bucket_of",
    "code_label",
    "failed_rules",
    "file_path",
    "plain_path",
    "record_hash",
    "set_digest",
    "surrogate_key",
]
