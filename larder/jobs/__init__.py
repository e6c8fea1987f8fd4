"""Jobs for ``spark-submit``. They take the session as submitted and set no master."""
