from lumenmart.functions.exprs import (  # noqa: F401
    UNKNOWN_SK,
    clean_name,
    date_key,
    json_field,
    json_int,
    key_to_date,
    month_key,
    ratio,
    seconds_between,
    surrogate_key,
    surrogate_key_of,
)
