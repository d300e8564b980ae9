from paneltide.functions.exprs import (  # noqa: F401
    direction_label,
    fill_zero,
    money,
    money_sum,
    parse_codes,
    post_dummy,
    safe_div,
    scale,
    share,
    to_ds,
    treated,
    trend_label,
    verdict,
    years_since,
)
