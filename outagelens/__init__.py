"""Service-desk incident analytics as Spark DataFrame jobs.

``functions`` holds Column builders, ``operators`` DataFrame transforms, ``sources``
readers and writers, ``plans`` whole jobs and ``streaming`` the same row work on
files as they land.
"""
