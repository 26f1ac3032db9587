"""Session settings in tests."""


class session_conf:
    """Session settings for the length of a block."""

    def __init__(self, spark, values):
        self.spark, self.values = spark, values

    def __enter__(self):
        self.before = {name: self.spark.conf.get(name, None) for name in self.values}
        for name, value in self.values.items():
            self.spark.conf.set(name, value)

    def __exit__(self, *error):
        for name, value in self.before.items():
            if value is None:
                self.spark.conf.unset(name)
            else:
                self.spark.conf.set(name, value)
