"""Tables that later jobs read: each is built once per session, written, and read back."""

import hashlib
import uuid

from shoplens.plans.jobs import JOBS, MODELS
from shoplens.session import shared_dir
from shoplens.sources.lake import overwrite

_OPEN = {}


class Workspace:
    """Job outputs over one folder of source tables, kept in the cluster's shared folder.

    Reading a written table instead of nesting plans keeps lineage short, so a lost executor
    repeats a part of one job and never the whole chain.
    """

    def __init__(self, spark, source, root=None):
        tag = hashlib.md5(str(source).encode()).hexdigest()[:12]
        self.spark, self.source = spark, source
        self.root = root or f"{shared_dir(spark)}/shoplens/{spark.sparkContext.applicationId}/{tag}"
        self._tables, self._models, self._folders = {}, {}, {}

    def path(self, name):
        return f"{self.root}/{name}"

    def stage(self, df, name):
        """Writes a frame to a folder of its own and reads it back: what is still read is never overwritten."""
        return overwrite(df, self.fresh(name))

    def fresh(self, name):
        """A folder that nobody has written yet."""
        return self.path(f"{name}/{uuid.uuid4().hex}")

    def folder(self, name, write):
        """A folder that ``write`` fills once per session."""
        if name not in self._folders:
            path = self.fresh(name)
            write(path)
            self._folders[name] = path
        return self._folders[name]

    def table(self, name):
        if name not in self._tables:
            self._tables[name] = self.stage(JOBS[name](self), name)
        return self._tables[name]

    def model(self, name):
        if name not in self._models:
            self._models[name] = MODELS[name](self, self.path(f"models/{name}"))
        return self._models[name]


def workspace(spark, source):
    """The session's workspace over a folder of tables."""
    key = (spark.sparkContext.applicationId, str(source))
    if key not in _OPEN:
        _OPEN[key] = Workspace(spark, source)
    return _OPEN[key]
