from visitlens.cli import main

main()
