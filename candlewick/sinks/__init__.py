"""Sinks: message encoders (K1-K3, S3) and idempotent table writers (K4-K8)."""
