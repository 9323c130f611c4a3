from daybook.cli import main

main()
