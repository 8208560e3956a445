"""Session settings for the length of a block."""

import contextlib


@contextlib.contextmanager
def configured(spark, confs):
    """Settings for a while; what they were before comes back."""
    before = {name: spark.conf.get(name, None) for name in confs}
    try:
        for name, value in confs.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
