"""Line stream from a TCP server. Spark cannot replay it after a failure; land
the lines in files or in a topic where that matters."""


def stream_socket(spark, host, port):
    return spark.readStream.format("socket").option("host", host).option("port", port).load()
