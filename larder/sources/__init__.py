"""Reading and writing: text files, cell tables, scratch tables, run outputs."""
