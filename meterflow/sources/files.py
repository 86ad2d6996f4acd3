"""Folders of any file system Spark can reach: list, look up, remove."""


def _path(spark, path):
    jvm = spark._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def exists(spark, path):
    fs, found = _path(spark, path)
    return fs.exists(found)


def folders(spark, path):
    """{name: seconds since its last change} of the folders in ``path``; none if it is not there."""
    fs, found = _path(spark, path)
    if not fs.exists(found):
        return {}
    now = spark._jvm.java.lang.System.currentTimeMillis()
    return {
        status.getPath().getName(): (now - status.getModificationTime()) / 1000
        for status in fs.listStatus(found) if status.isDirectory()
    }


def remove(spark, path):
    fs, found = _path(spark, path)
    return fs.delete(found, True)


def remove_at_exit(spark, path):
    """Remove the folder when the session's JVM ends."""
    fs, found = _path(spark, path)
    fs.deleteOnExit(found)
