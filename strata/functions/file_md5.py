"""md5 of whole files, their bytes streamed through the digest where the task runs.

Spark's ``binaryFile`` holds a file as one value: at most 2^31 - 1 bytes, and several
copies of it in memory.  An md5 can be neither split nor merged, so one task reads a
file from end to end, but it needs no more of it than a buffer.  Python workers cannot
open the stores that Spark reads, so the digest is a small JVM function: compiled once
with the compiler that Spark itself generates code with, sent to the executors as a jar,
and reading through the Hadoop file system with the session's settings.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import zipfile

from pyspark.sql import Column
from pyspark.sql import functions as F

CLASS = "strata.FileMd5"
# A file that fails to open or read is NULL where the session ignores such files, by the rules of Spark's readers.
SOURCE = """
package strata;

import java.io.FileNotFoundException;
import java.io.IOException;
import java.security.MessageDigest;
import org.apache.commons.codec.binary.Hex;
import org.apache.hadoop.conf.Configuration;
import org.apache.hadoop.fs.FSDataInputStream;
import org.apache.hadoop.fs.Path;
import org.apache.hadoop.hdfs.BlockMissingException;
import org.apache.hadoop.security.AccessControlException;
import org.apache.spark.sql.api.java.UDF1;
import org.apache.spark.util.SerializableConfiguration;

public class FileMd5 implements UDF1 {
  private static final long serialVersionUID = 1L;
  private final SerializableConfiguration conf;

  public FileMd5(SerializableConfiguration conf) {
    this.conf = conf;
  }

  public Object call(Object path) throws Exception {
    Configuration c = conf.value();
    try {
      return md5(new Path((String) path), c);
    } catch (Exception e) {
      boolean missing = e instanceof FileNotFoundException;
      boolean denied = e instanceof AccessControlException || e instanceof BlockMissingException;
      String flag = missing ? "spark.sql.files.ignoreMissingFiles" : "spark.sql.files.ignoreCorruptFiles";
      if (!denied && c.getBoolean(flag, false)) return null;
      throw new IOException("cannot read " + path, e);
    }
  }

  private static String md5(Path path, Configuration c) throws Exception {
    MessageDigest digest = MessageDigest.getInstance("MD5");
    byte[] buffer = new byte[1 << 20];
    FSDataInputStream in = path.getFileSystem(c).open(path);
    try {
      for (int n = in.read(buffer); n >= 0; n = in.read(buffer)) digest.update(buffer, 0, n);
    } finally {
      in.close();
    }
    return new String(Hex.encodeHex(digest.digest()));
  }
}
"""


def _compiled(spark):
    """The class, its jar added to the application once."""
    compiler = spark._jvm.org.codehaus.janino.SimpleCompiler()
    compiler.cook(SOURCE)
    name = f"strata-file-md5-{hashlib.md5(SOURCE.encode()).hexdigest()[:16]}.jar"
    if name not in spark.sparkContext._jsc.sc().listJars().mkString("\n"):
        jar = os.path.join(tempfile.mkdtemp(prefix="strata-jar-"), name)
        with zipfile.ZipFile(jar, "w") as z:
            for cls, code in compiler.getBytecodes().items():
                z.writestr(cls.replace(".", "/") + ".class", bytes(code))
        spark.sparkContext._jsc.addJar(jar)
    return compiler.getClassLoader().loadClass(CLASS)


def file_md5(spark, path: Column) -> Column:
    """md5 (hex) of the file at ``path``, as ``md5`` of its whole content would give.

    The function is registered once per session and file system settings, so two reads of
    the same files are one plan to Spark, which may then read them once.
    """
    jvm = spark._jvm
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    text = jvm.java.io.StringWriter()
    conf.writeXml(text)
    name = f"strata_file_md5_{hashlib.md5(text.toString().encode()).hexdigest()}"
    if not spark.catalog.functionExists(name):
        args = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 1)
        args[0] = jvm.org.apache.spark.util.SerializableConfiguration(conf)
        udf = _compiled(spark).getConstructors()[0].newInstance(args)
        spark._jsparkSession.udf().register(name, udf, jvm.org.apache.spark.sql.types.DataTypes.StringType)
    return F.call_udf(name, path)
