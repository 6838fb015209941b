from candlewick.functions.timecols import epoch_micros, ntz_from_micros, bucket_start_micros
from candlewick.functions.numeric import dec, dec_sum, dec_mean, to_double

__all__ = [
    "epoch_micros", "ntz_from_micros", "bucket_start_micros",
    "dec", "dec_sum", "dec_mean", "to_double",
]
