"""Where tables come from and go to; the only modules that do I/O."""
