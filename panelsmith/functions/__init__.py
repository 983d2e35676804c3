from panelsmith.functions.columns import (  # noqa: F401
    any_null,
    drop_missing,
    invert_when,
    lenient_cast,
    nan_to_null,
    norm_columns,
    norm_string,
    override_chain,
    quote_suffix_invert,
    rename,
    round_doubles,
    select_slice,
    strict_cast,
    zero_fill,
)
from panelsmith.functions.dates import (  # noqa: F401
    day_before,
    from_yyyymmdd,
    month_from_name,
    month_label_parts,
    month_start,
    period_from_label,
    prev_month_end,
    quarter_month,
    yyyymm,
    yyyymmdd,
)
from panelsmith.functions.hashing import fold_of, masked, md5_bucket, split_label  # noqa: F401
