"""Where rows come from and go to: change streams, files, stored tables."""
