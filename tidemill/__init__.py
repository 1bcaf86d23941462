"""tidemill: a layered analytics warehouse written as lazy PySpark DataFrame functions."""
