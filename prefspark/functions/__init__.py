from prefspark.functions.exprs import (  # noqa: F401
    TOKEN_PATTERN,
    log_sigmoid,
    md5_key,
    round6,
    softplus,
    tokens,
    unit_uniform,
)
