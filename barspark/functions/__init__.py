from .expr import (ieee_div, safe_cast, strict_cast, sign,
                   frequency_us, epoch_us, local_to_utc, valid_at)

__all__ = ["ieee_div", "safe_cast", "strict_cast", "sign",
           "frequency_us", "epoch_us", "local_to_utc", "valid_at"]
