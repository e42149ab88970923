"""Send this package to the executors, so that its Python functions can be imported there."""

import os
import tempfile
import zipfile

_sent = set()


def ship(spark):
    """Add the package as a zip to the session, once per application."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="basketlens-"), "basketlens.zip")
    with zipfile.ZipFile(path, "w") as packed:
        for folder, _, files in os.walk(root):
            for name in sorted(files):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    packed.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    _sent.add(context.applicationId)


def shipped(function):
    """The same (spark, …) function, with the package sent first."""
    def run(spark, *args):
        ship(spark)
        return function(spark, *args)
    return run
