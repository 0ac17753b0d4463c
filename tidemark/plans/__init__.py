"""Jobs and reads with the parameters a caller passes."""
