"""Where rows come from and go to: files, tables, constant and generated relations."""
