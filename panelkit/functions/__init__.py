from panelkit.functions.scalar import (  # noqa: F401
    bytes_to_mb,
    colref,
    decoded_path,
    file_stem,
    fixed_text,
    round_half_up,
    row_mean,
    safe_corr,
    safe_div,
    thousands_text,
)
